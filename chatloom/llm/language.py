"""Language identification with a blended-spectrum string kernel (operator 10).

The kernel of two texts counts the character 1- to 3-grams that both have,
presence only, over the root of the product of their own counts. Nyström
landmarks from a bounded labelled sample map texts to a feature space in which
one-versus-rest kernel ridge regression is solved. As every value is linear in
the presence vector, landmarks and weights fold into one matrix (n-gram bucket by
language), and batches are scored by a product of presence and this matrix.

Defined results: null text and text without a letter is ``und`` with score 0, as
is every text if no labelled row can be learned from; ties go to the language
first in alphabetical order; a null doc_id is never learned from and not held
out; whole texts count; repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, stored

#: Bounds of the training sample: rows of one language, and of all.
ROWS_PER_LANGUAGE = 300
SAMPLE_ROWS = 19_200
#: How many times as many texts pass the hash threshold before they are ranked, as if at least so many were wanted.
OVERSAMPLE, LEAST_LET = 8, 8
LANDMARKS_PER_LANGUAGE = 40
RIDGE = 1e-2
ORDERS = (1, 2, 3)
BITS = 17
#: Texts scored by one matrix product.
PRODUCT_ROWS = 64
_MIX = np.uint32(2654435761)


def grams(text: str) -> np.ndarray:
    """Buckets of the distinct character n-grams of a whole text, in ascending order."""
    c = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    seen = np.zeros(1 << BITS, bool)
    rolled = np.zeros(len(c), np.uint32)
    for n in ORDERS:
        if len(c) < n:
            break
        rolled = (rolled[: len(c) - n + 1] * np.uint32(31) + c[n - 1 :] + np.uint32(n)) * _MIX
        seen[rolled >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(seen).astype(np.int32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass(frozen=True)
class KernelClassifier:
    languages: tuple[str, ...]
    vocabulary: np.ndarray  # bucket -> row of ``weights``, -1 if no landmark has it
    weights: np.ndarray

    @classmethod
    def fit(cls, rows: list[tuple[str, np.ndarray]], ridge: float = RIDGE) -> KernelClassifier:
        """``rows``: (language, buckets) of the sample; the first of each language are landmarks."""
        languages = tuple(sorted({lang for lang, _ in rows}))
        taken: dict[str, int] = {}
        marks = []
        for lang, g in rows:
            taken[lang] = taken.get(lang, 0) + 1
            if taken[lang] <= LANDMARKS_PER_LANGUAGE:
                marks.append(g)
        buckets = np.unique(np.concatenate([*marks, np.zeros(0, np.int32)]))
        vocabulary = np.full(1 << BITS, -1, np.int32)
        vocabulary[buckets] = np.arange(len(buckets))
        if not languages:
            return cls((), vocabulary, np.zeros((0, 0), np.float32))

        def presence(sets: list[np.ndarray]) -> np.ndarray:
            out = np.zeros((len(sets), len(buckets)), np.float32)
            for i, g in enumerate(sets):
                own = vocabulary[g]
                out[i, own[own >= 0]] = 1
            return out

        root = lambda sets: np.sqrt(np.maximum([len(g) for g in sets], 1))
        z, z_root = presence(marks), root(marks)
        among = (z @ z.T).astype(float) / np.outer(z_root, z_root)
        values, vectors = np.linalg.eigh(among)
        good = values > 1e-8 * max(values[-1], 1e-8)
        whiten = vectors[:, good] / np.sqrt(values[good])
        phi = np.concatenate(
            [
                (presence([g for _, g in rows[a : a + 512]]) @ z.T).astype(float) / np.outer(root([g for _, g in rows[a : a + 512]]), z_root) @ whiten
                for a in range(0, len(rows), 512)
            ]
        )
        y = np.array([[lang == k for k in languages] for lang, _ in rows], float)
        beta = whiten @ np.linalg.solve(phi.T @ phi + ridge * len(rows) / 100 * np.eye(phi.shape[1]), phi.T @ y)
        return cls(languages, vocabulary, (z.T @ (beta / z_root[:, None])).astype(np.float32))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if not self.languages:
            return out
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        for a in range(0, len(known), PRODUCT_ROWS):
            part = known[a : a + PRODUCT_ROWS]
            x = np.zeros((len(part), len(self.weights)), np.float32)
            sizes = np.ones(len(part))
            for row, i in enumerate(part):
                g = grams(texts[i])
                own = self.vocabulary[g]
                x[row, own[own >= 0]] = 1
                sizes[row] = max(len(g), 1)
            scores = (x @ self.weights) / np.sqrt(sizes)[:, None]
            best = scores.argmax(axis=1)
            for row, i in enumerate(part):
                out[i] = (self.languages[best[row]], float(np.clip(scores[row, best[row]], 0, 1)))
        return out


def held_out() -> Column:
    """Whether a document is kept from learning: crc32 of its id as text is 1 modulo 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> KernelClassifier:
    """Learn from at most ``rows`` texts of each language that are not held out, and at most
    ``SAMPLE_ROWS`` of all (but one of each language in any case).

    A text's hash decides whether it is in the sample: first against a threshold by the
    number of the language's different texts, so that few rows move and copies do not
    crowd others out, then by rank among those. Only the sample reaches the driver, as
    n-gram buckets.
    """
    usable = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out()).select("lang", "text")
    counts = stored(usable.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n_texts")), "languages")
    rows = max(1, min(rows, SAMPLE_ROWS // max(1, counts.count())))
    limit = F.least(F.lit(1.0), F.lit(OVERSAMPLE * max(rows, LEAST_LET)) / F.col("n_texts")) * F.lit(float(1 << 31))
    hashed = usable.join(counts.withColumnRenamed("lang", "own_lang"), F.col("lang") == F.col("own_lang"))
    hashed = hashed.withColumn("h", F.xxhash64("text")).where(F.shiftrightunsigned("h", 33) < limit)
    order = Window.partitionBy("lang").orderBy("h", "text")
    chosen = hashed.select("lang", "h", "text").distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows)

    def step(batch: dict[str, list]) -> dict[str, list]:
        ok = [i for i, t in enumerate(batch["text"]) if has_letter(t)]
        return {
            "lang": [batch["lang"][i] for i in ok], "rank": [batch["rank"][i] for i in ok],
            "grams": [grams(batch["text"][i]).tobytes() for i in ok],
        }

    found = map_batches(chosen, ["lang", "rank", "text"], "lang string, rank int, grams binary", step).collect()
    found.sort(key=lambda r: (r["rank"], r.lang))
    return KernelClassifier.fit([(r.lang, np.frombuffer(bytes(r.grams), np.int32)) for r in found])


def identify(docs: DataFrame, model: KernelClassifier) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every whole text."""

    def step(rows: dict[str, list]) -> dict[str, list]:
        found = model.predict(rows["text"])
        return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "lang_pred": [a for a, _ in found], "score": [b for _, b in found]}

    marked = docs.select("doc_id", "text", held_out().alias("held_out"))
    return map_batches(marked, ["doc_id", "held_out", "text"], "doc_id bigint, held_out boolean, lang_pred string, score double", step)
