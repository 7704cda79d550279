"""Secret scans by character Markov models (operator 3).

Besides three fixed patterns, two first-order character models, one of random
strings and one of ordinary identifiers, are trained from labelled samples. A
run of key characters whose log-likelihood ratio per step is above a threshold
is a secret of kind ``random``. Runs under ``RANDOM_LENGTH`` are too short for the
models to judge. The fixed patterns' spans always stay.

Defined results: null and empty texts have no spans; spans are code points with
the end exclusive; spans of different kinds may overlap; repeated rows give
repeated results; texts of any length are read whole; where two runs score the same
both or neither are secrets; an empty table gives no rows; only doc_id and text are
read, so extra columns never clash.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import map_batches

KINDS = ("assign", "access", "hex", "random")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
#: Shortest run that the models judge.
RANDOM_LENGTH = 20
#: Least mean log-likelihood ratio a step, in nats, of a random string.
THRESHOLD = 0.35
#: Strings a model is trained on, at most.
SAMPLE = 5_000

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ASSIGN_WORDS = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"' :=]", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RANDOM_LENGTH)
#: Classes of characters: each lower-case letter, capital by letter, digit, other key characters.
_CODES = np.full(128, -1, np.int16)
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"):
    _CODES[ord(_c)] = _i
N_CODES = 67


@dataclass(frozen=True)
class MarkovModel:
    """Log probabilities of a character after another, with add-one smoothing."""

    steps: np.ndarray

    @classmethod
    def train(cls, strings: list[str]) -> MarkovModel:
        counts = np.ones((N_CODES, N_CODES))
        for s in strings:
            c = codes(s)
            np.add.at(counts, (c[:-1], c[1:]), 1)
        return cls(np.log(counts / counts.sum(axis=1, keepdims=True)))


def codes(s: str) -> np.ndarray:
    """The key characters of ``s`` as codes; others are left out."""
    raw = np.frombuffer(s.encode("ascii", "ignore"), np.uint8)
    found = _CODES[raw & 127]
    return found[found >= 0]


def labelled_samples(size: int = SAMPLE, seed: int = 7) -> list[tuple[str, int]]:
    """(string, 1 for random or 0 for ordinary), made by rule from a fixed seed.

    Random strings are drawn evenly from the alphabets of keys; identifiers join
    words of alternating consonants and vowels, and common parts of names, in the
    usual ways (snake, kebab, camel, path, capitals), some with a number at the end;
    a share of the ordinary ones are plain numbers, dates and repeated characters.
    """
    rng = random.Random(seed)
    lower = "abcdefghijklmnopqrstuvwxyz"
    alphabets = (
        lower + lower.upper() + "0123456789", lower + lower.upper() + "0123456789+/", lower + "0123456789",
        lower.upper() + "0123456789", lower + lower.upper() + "0123456789_-",
    )
    parts = (
        "user name file path data value index count total list item node tree graph token count table column row key "
        "message thread reader writer parser handler manager factory service client server request response error "
        "config option default test case result input output stream buffer cache page title content image link style "
        "version release download update create delete insert select order group filter search the and that with from"
    ).split()
    syllables = [c + v for c in "bcdfghlmnprstvw" for v in "aeiou"] + ["th", "er", "ing", "tion", "ent", "st", "ou", "ea"]
    out: list[tuple[str, int]] = []
    for i in range(size):
        letters = alphabets[i % len(alphabets)]
        out.append(("".join(rng.choice(letters) for _ in range(rng.randint(20, 48))), 1))
        words = [rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(3, 7))]
        style = rng.randrange(10)
        if style == 0:
            s = "_".join(words)
        elif style == 1:
            s = "-".join(words)
        elif style == 2:
            s = "".join(w.capitalize() for w in words)
        elif style == 3:
            s = "/".join(words)
        elif style == 4:
            s = "_".join(words).upper()
        elif style == 5:
            s = rng.choice(("-", "")).join(words).upper()
        elif style == 6:
            s = "/".join(rng.choice((w, w.capitalize(), w.upper(), f"{w}-{rng.choice(parts)}", f"{w}_{rng.choice(parts)}")) for w in words)
        elif style == 7:
            s = rng.choice(("", "-", "/", "_")).join(f"{rng.randrange(10**n):0{n}d}" for n in (rng.choice((2, 2, 4, 6, 10)) for _ in range(rng.randint(4, 8))))
        elif style == 8:
            s = "".join(c * rng.randint(4, 30) for c in rng.choices("-=_+/" * 6 + lower + lower.upper(), k=rng.choice((1, 1, 2))))
        else:
            s = "".join(words)
        out.append((s + (str(rng.randint(0, 2030)) if rng.random() < 0.3 else ""), 0))
    return out


class SecretScanner:
    """The fixed patterns and a pair of trained models."""

    def __init__(self, samples: list[tuple[str, int]] | None = None, threshold: float = THRESHOLD):
        samples = labelled_samples() if samples is None else samples
        if len(samples) > 2 * SAMPLE:
            raise ValueError(f"more than {2 * SAMPLE} samples")
        likely = [MarkovModel.train([s for s, label in samples if label == k]).steps for k in (0, 1)]
        self.ratio = likely[1] - likely[0]
        self.threshold = threshold

    def score(self, s: str) -> float:
        """Mean log-likelihood ratio of a step: above 0 is more like a random string."""
        c = codes(s)
        return float(self.ratio[c[:-1], c[1:]].mean()) if len(c) > 1 else 0.0

    def is_random(self, s: str) -> bool:
        """Whether the likelihood ratio is above the threshold; nothing else counts."""
        return self.score(s) > self.threshold

    def spans(self, text: str | None, runs: bool = True) -> list[tuple[int, int, str]]:
        """All (start, end, kind) of a text by start, then kind as listed.

        ``runs=False`` says that the text has no run of ``RANDOM_LENGTH`` key characters.
        """
        if not text:
            return []
        found: list[tuple[int, int, str]] = []
        if _ASSIGN_WORDS.search(text):
            found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
        if runs:
            for run in _RUN.finditer(text):
                at, s = run.start(), run.group()
                # keys and hex runs of enough length lie within one run of key characters
                for kind, pattern, least in (("access", _ACCESS, ACCESS_LENGTH), ("hex", _HEX, HEX_LENGTH)):
                    found += [(at + m.start(), at + m.end(), kind) for m in pattern.finditer(s) if m.end() - m.start() >= least]
                if self.is_random(s):
                    found.append((at, run.end(), "random"))
        return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))

    def redact(self, text: str | None, mark: str = "[SECRET]", runs: bool = True) -> str | None:
        """The text with every span, joined where they overlap, replaced by ``mark``."""
        if not text:
            return text
        out, at = [], 0
        merged: list[list[int]] = []
        for a, b, _ in self.spans(text, runs):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in merged:
            out += [text[at:a], mark]
            at = b
        return "".join([*out, text[at:]])


_IS_KEY = _CODES.copy() >= 0


def with_runs(texts: list[str | None]) -> list[bool]:
    """Which texts have a run of ``RANDOM_LENGTH`` key characters, found in one vectorised sweep."""
    joined = "\0".join(t or "" for t in texts).encode()
    raw = np.frombuffer(joined, np.uint8)
    key = np.concatenate([[False], _IS_KEY[raw & 127] & (raw < 128), [False]])
    edges = np.flatnonzero(key[1:] != key[:-1])
    long = edges[::2][edges[1::2] - edges[::2] >= RANDOM_LENGTH]
    ends = np.cumsum([len((t or "").encode()) + 1 for t in texts])
    has = np.zeros(len(texts), bool)
    has[np.searchsorted(ends, long, "right")] = True
    return has.tolist()


def scan(docs: DataFrame, samples: list[tuple[str, int]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The spans of every text: (doc_id, spans array of (kind, start, end))."""
    scanner = SecretScanner(samples, threshold)

    def step(rows: dict[str, list]) -> dict[str, list]:
        texts = rows["text"]
        found = [scanner.spans(t, r) for t, r in zip(texts, with_runs(texts), strict=True)]
        return {
            "doc_id": rows["doc_id"],
            "spans": [[{"kind": k, "start": a, "end": b} for a, b, k in spans] for spans in found],
        }

    return map_batches(docs, ["doc_id", "text"], "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>", step)


def redact(docs: DataFrame, samples: list[tuple[str, int]] | None = None) -> DataFrame:
    """All rows and columns of ``docs``, secrets in ``text`` replaced.

    Where a text changes, ``n_chars``, if there is such a column of numbers, follows.
    """
    scanner = SecretScanner(samples)
    # by place, so that any name will do
    names = [f"own_{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    at = docs.columns.index("n_chars") if "n_chars" in docs.columns else -1
    size = names[at] if at >= 0 and docs.dtypes[at][1] in ("int", "bigint") else None

    def step(rows: dict[str, list]) -> dict[str, list]:
        out, sizes = [], list(rows[size]) if size else []
        for i, (old, runs) in enumerate(zip(rows[text], with_runs(rows[text]), strict=True)):
            new = scanner.redact(old, runs=runs)
            if size and new != old:
                sizes[i] = len(new)
            out.append(new)
        return rows | {text: out} | ({size: sizes} if size else {})

    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))
    return map_batches(docs.toDF(*names), names, schema, step).toDF(*docs.columns)


def secret_report(docs: DataFrame, samples: list[tuple[str, int]] | None = None) -> DataFrame:
    """Counts, digest and all spans of every document, in the form of query op3."""
    scanner = SecretScanner(samples)
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for a, b, k in spans)

    def step(rows: dict[str, list]) -> dict[str, list]:
        texts = rows["text"]
        found = [scanner.spans(t, r) for t, r in zip(texts, with_runs(texts), strict=True)]
        base = [[s for s in spans if s[2] != "random"] for spans in found]
        count = lambda kind: [sum(s[2] == kind for s in spans) for spans in found]
        return {
            "doc_id": rows["doc_id"], "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"),
            "base_sha256": [hashlib.sha256(joined(b).encode()).hexdigest() for b in base],
            "spans": [joined(s) for s in found], "n_random": count("random"),
        }

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint"
    return map_batches(docs, ["doc_id", "text"], schema, step)
