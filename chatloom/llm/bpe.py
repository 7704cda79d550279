"""BPE encoding and decoding by a prefix-sharing trie (operator 8).

The distinct words of a batch that are not yet known form a byte trie. A
depth-first walk gives each node one state: the last token of the encoding of
the prefix that ends there. An encoding of a prefix is the encoding of the
prefix without that token, plus the token, so a state needs only a look at the
states above it, and prefixes that words share are encoded once. A token may
follow another if no merge across their border would have come first.

Defined results: null and empty text have no ids and decode to the empty
string; the string of an added token becomes that token's id, as in the
tokenizers library; repeated rows give repeated results; only the named columns
are read, so extra columns never clash.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_arrow, map_batches
from .words import IS_SPACE, text_bytes

#: Words whose ids a worker remembers before it forgets those that were not asked for since as many were new.
MEMO_WORDS = 220_000
MEMO_PAIRS = 500_000
#: Steps of the automaton that a worker remembers.
MEMO_STEPS = 500_000
#: Letters of the longest piece whose ids are remembered.
MEMO_LETTERS = 64

# The letters, numbers and spaces among the code points below
# U+0250, for the split pattern of byte-level BPE. Texts with other code points
# (but for the punctuation and currency blocks) are split by the library.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACES = "\t-\r \x85\xa0"
_OTHER_CODES = re.compile("[^\x00-ɏ‐-‧‰-⁞₠-₿]")
_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+"
    rf"| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)


#: The spaces beyond ASCII that the split pattern knows, as UTF-8, and the bytes that they begin with.
_WIDE_SPACES = [int.from_bytes(chr(c).encode()) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: Latin letters beyond ASCII, all as one of ASCII.
_LATIN = dict.fromkeys([c for c in range(0x80, 0x250) if chr(c).isalpha()], "a")
_IS_STOP = np.isin(np.arange(256), list(b".,;:!?"))
_IS_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
_SPACE_LEADS = np.array([0xC2, 0xE1, 0xE2, 0xE3], np.uint8)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieBpe:
    """A byte-level BPE vocabulary with its trie encoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.path = path
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = raw(token)
        self.ids = {b: i for i, b in enumerate(self.token_bytes) if b}
        for content, i in self.added.items():
            self.token_bytes[i] = content.encode()
        self._automaton()
        self.sizes = [len(b) for b in self.token_bytes]
        #: (left id, right id) -> rank; by token its own rank and parts
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.ranks[a, b] = rank
            self.made.setdefault(c, (rank, a, b))
        self._spines: tuple[dict, dict] = ({}, {})
        self._follows: defaultdict[int, dict[int, bool]] = defaultdict(dict)
        #: Ids by word or piece of text (a word with what stands beside it), the latest and those before.
        self.memo: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self._library = None
        self._added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None

    def _automaton(self) -> None:
        """Aho-Corasick over all tokens: ``step`` (node * 256 + byte -> node), ``back`` (the node of
        the longest shorter ending) and ``ends`` (the tokens that end at a node with their lengths,
        longest first)."""
        self.step: dict[int, int] = {}
        self.back, self.ends = [0], [()]
        order: list[list[tuple[int, int, int]]] = []  # (node, parent, byte) by depth
        own = [-1]
        for raw, token in self.ids.items():
            node = 0
            for depth, byte in enumerate(raw):
                key = node << 8 | byte
                child = self.step.get(key)
                if child is None:
                    child = self.step[key] = len(own)
                    own.append(-1)
                    if depth == len(order):
                        order.append([])
                    order[depth].append((child, node, byte))
                node = child
            own[node] = token
        self.back, self.ends = [0] * len(own), [()] * len(own)
        for depth, level in enumerate(order, 1):
            for node, parent, byte in level:
                at = parent
                while at:
                    at = self.back[at]
                    if (found := self.step.get(at << 8 | byte)) is not None:
                        self.back[node] = found
                        break
                rest = self.ends[self.back[node]]
                self.ends[node] = ((own[node], depth), *rest) if own[node] >= 0 else rest

    # -- borders ---------------------------------------------------------
    def _spine(self, token: int, right: bool) -> list[tuple[int, float]]:
        """The pieces that lie at a token's right (left) end while it is built, each
        with the rank of the merge that ends it."""
        known = self._spines[right]
        if token not in known:
            pieces, ends = [], float("inf")
            piece: int | None = token
            while piece is not None:
                pieces.append((piece, ends))
                made = self.made.get(piece)
                piece, ends = (made[1 + right], made[0]) if made else (None, ends)
            known[token] = pieces
        return known[token]

    def follows(self, a: int, b: int) -> bool:
        """Whether token ``b`` can stand right after token ``a``.

        It can't if two end pieces have a merge that comes before both their own
        ends; of equal merges the one further left comes first.
        """
        for x, x_ends in self._spine(a, True):
            for y, y_ends in self._spine(b, False):
                rank = self.ranks.get((x, y))
                if rank is not None and rank < x_ends and rank <= y_ends:
                    return False
        return True

    # -- trie ------------------------------------------------------------
    def learn(self, words: set[str]) -> None:
        """Encode new words along their byte trie.

        In byte order the words are the trie's nodes in depth-first order, so the
        trie needs no nodes of its own: ``last`` holds the states on the path from
        the root, and only the states below the branch from the word before are
        computed.
        """
        step, back, ends = self.step, self.back, self.ends
        sizes, follows, memo = self.sizes, self.follows, self.memo
        known = self._follows
        if sum(map(len, known.values())) > MEMO_PAIRS:
            known.clear()
        # by depth: the last token of the prefix, and the automaton's node
        last, nodes, before = [-1], [0], b""
        # code points order as their UTF-8 bytes do
        for word in sorted(words):
            path = word.encode()
            shared = 0
            for x, y in zip(before, path):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], nodes[shared + 1 :]
            node, depth = nodes[shared], shared
            for byte in path[shared:]:
                depth += 1
                key = node << 8 | byte
                child = step.get(key)
                if child is None:
                    while child is None:
                        node = back[node]
                        child = step.get(node << 8 | byte)
                    # found once, it is a step like any other
                    if len(step) < MEMO_STEPS:
                        step[key] = child
                node = child
                nodes.append(node)
                # the one token that ends here and may follow the state it leaves
                for token, size in ends[node]:
                    if size == depth:
                        break
                    before_it = last[depth - size]
                    fits = known[before_it].get(token)
                    if fits is None:
                        fits = known[before_it][token] = follows(before_it, token)
                    if fits:
                        break
                last.append(token)
            tokens = []
            while depth:
                token = last[depth]
                tokens.append(token)
                depth -= sizes[token]
            tokens.reverse()
            memo[word] = array("I", tokens).tobytes()
            before = path

    # -- texts -----------------------------------------------------------
    def split(self, text: str) -> list[str]:
        """The words of a text between added tokens, as the library splits them."""
        if _OTHER_CODES.search(text) is None:
            return _SPLIT.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def _cuts(self, raw: np.ndarray, places: np.ndarray, marked: np.ndarray) -> np.ndarray:
        """The places where the pieces of the texts begin, in order.

        No word goes on over the last of a run of spaces that something else follows, so
        texts are cut before it, and none goes on from a letter to a stop. Texts with an
        added token (``marked``) or with spaces beyond ASCII are one piece each.
        """
        space = IS_SPACE[raw]
        cut = space.copy()
        cut[:-1] &= ~space[1:]
        cut[-1] = False
        first, last = places[:-1], places[1:]
        some = last > first
        # spaces at a text's end, which the next text's first letter does not end
        ends = last[some] - 1
        cut[ends] = False
        cut[first[some]] = True
        stops = np.flatnonzero(_IS_STOP[raw])
        stops = stops[stops > 1]
        before = raw[stops - 1]
        # a Latin letter of one byte, or of two
        cut[stops[_IS_LETTER[before] | (raw[stops - 2] == 0xC3) & (before != 0x97) & (before != 0xB7)]] = True
        lead = np.flatnonzero(np.isin(raw, _SPACE_LEADS))
        lead = lead[lead + 2 < len(raw)] if len(lead) else lead
        if len(lead):
            code = raw[lead].astype(np.int64) << 16 | raw[lead + 1].astype(np.int64) << 8 | raw[lead + 2]
            wide = np.isin(code, _WIDE_SPACES) | np.isin(code >> 8, _WIDE_SPACES)
            marked = marked.copy()
            marked[np.searchsorted(places, lead[wide], "right") - 1] = True
        if len(raw) > 1 and int(raw[-2]) << 8 | int(raw[-1]) in _WIDE_SPACES:
            marked = marked.copy()
            marked[-1 - int(np.argmax(some[::-1]))] = True
        for i in np.flatnonzero(marked & some):
            cut[first[i] + 1 : last[i]] = False
        return np.flatnonzero(cut)

    def encode_array(self, texts: pa.Array, specials: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (u32), and the n + 1 places where the texts' ids begin.

        ``specials=False`` takes the strings of added tokens as ordinary text. Each distinct
        piece of the texts is looked up once, and the ids of all are taken by its number.
        """
        if len(self.memo) > MEMO_WORDS:
            self.before, self.memo = self.memo, {}
        on = gc.isenabled()
        # a million new strings are no garbage
        gc.disable()
        try:
            return self._encode_array(texts, specials)
        finally:
            if on:
                gc.enable()

    def _encode_array(self, texts: pa.Array, specials: bool) -> tuple[np.ndarray, np.ndarray]:
        raw, places = text_bytes(texts)
        if not len(raw):
            return np.zeros(0, "<u4"), np.zeros(len(places), np.int64)
        marked = np.zeros(len(texts), bool)
        for token in self.added if specials else ():
            marked |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        begins = self._cuts(raw, places, marked)
        edges = np.append(begins, len(raw)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = pieces.dictionary_encode()
        found = self._pieces_ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), bool(marked.any()))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        which = coded.indices.to_numpy()
        counts = sizes[which]
        total = np.cumsum(counts)
        shift = (np.cumsum(sizes) - sizes)[which] - (total - counts)
        ids = flat[np.repeat(shift, counts) + np.arange(int(total[-1]))]
        return ids, np.concatenate([[0], total])[np.searchsorted(begins, places)]

    def _pieces_ids(self, pieces: list[str], specials: bool) -> list[bytes]:
        """The ids of each of the pieces, which differ from one another; with ``specials`` added tokens may be in them."""
        memo, before = self.memo, self.before
        found = list(map(memo.get, pieces))
        marks = tuple(self.added) if specials else ()
        if specials:
            # what is remembered is ordinary text
            found = [None if any(m in text for m in marks) else ids for text, ids in zip(pieces, found, strict=True)]
        words: list[int] = []
        cut: list[tuple[int, list[str | int], bool]] = []
        new: set[str] = set()
        for i in [i for i, ids in enumerate(found) if ids is None]:
            text = pieces[i]
            # an added token is one by choice, and what is long is not said again
            marked = bool(marks) and any(m in text for m in marks)
            if not marked and (ids := before.get(text)) is not None:
                found[i] = memo[text] = ids
                continue
            core = text[1:] if text[0] == " " else text
            if not marked and core.isalpha() and (core.isascii() or core.translate(_LATIN).isascii()):
                words.append(i)
                new.add(text)
                continue
            kept = not marked and len(text) <= MEMO_LETTERS
            parts: list[str | int] = []
            for k, part in enumerate(self._added.split(text) if marked else (text,)):
                parts += [self.added[part]] if k % 2 else self.split(part)
            cut.append((i, parts, kept))
            new.update([w for w in parts if isinstance(w, str) and w not in memo])
        if new:
            self.learn(new)
        for i in words:
            found[i] = memo[pieces[i]]
        for i, parts, kept in cut:
            found[i] = ids = b"".join([memo[w] if isinstance(w, str) else array("I", [w]).tobytes() for w in parts])
            if kept:
                memo[pieces[i]] = ids
        return found

    def encode(self, texts: list[str | None], specials: bool = True) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return packed(*self.encode_array(pa.array(texts, pa.large_string()), specials))

    def decode(self, ids: bytes) -> str:
        """The text of packed ids, added tokens included; broken UTF-8 is replaced."""
        return b"".join(map(self.token_bytes.__getitem__, array("I", ids))).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> TrieBpe:
    """One encoder for each worker and vocabulary file, which the garbage collector need not walk through."""
    made = TrieBpe(path)
    gc.freeze()
    return made


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every text: (key, n_tokens long, ids binary of little-endian u32)."""

    def step(keys: pa.Array, texts: pa.Array):
        ids, places = encoder(path).encode_array(texts)
        yield {key: keys, "n_tokens": np.diff(places), "ids": packed(ids, places)}

    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(docs, [key, text], f"`{key}` {kind}, n_tokens bigint, ids binary", step)


def packed(ids: np.ndarray, places: np.ndarray) -> list[bytes]:
    """The ids of each text as bytes."""
    return [ids[a:b].tobytes() for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]


def decode_documents(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Texts of packed ids: (key, text)."""

    def step(rows: dict[str, list]) -> dict[str, list]:
        bpe = encoder(path)
        return {key: rows[key], "text": [bpe.decode(x or b"") for x in rows["ids"]]}

    kind = encoded.schema[key].dataType.simpleString()
    return map_batches(encoded, [key, "ids"], f"`{key}` {kind}, text string", step)


def encode_with_digest(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids, and digests of ids and decoded text."""

    def step(keys: pa.Array, texts: pa.Array):
        bpe = encoder(path)
        ids = packed(*bpe.encode_array(texts))
        digest = lambda data: hashlib.sha256(data).hexdigest()
        yield {
            "doc_id": keys,
            "n_tokens": [len(x) // 4 for x in ids],
            "ids": ids,
            "ids_sha256": [digest(x) for x in ids],
            "decoded_sha256": [digest(bpe.decode(x).encode()) for x in ids],
        }

    return map_arrow(
        docs, ["doc_id", "text"],
        "doc_id bigint, n_tokens bigint, ids binary, ids_sha256 string, decoded_sha256 string", step,
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text; digests of both results per document."""
    return encode_with_digest(docs, path).drop("ids")
