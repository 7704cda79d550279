"""Assignment of messages to threads, one at a time in order of arrival.

``Assigner`` is the state of one chat: plain data, so that it can live in a group of
a batch or in the state of a stream. A message goes to the thread it quotes; else to
its sender's last thread in a monologue; else to the best open thread if that is good
enough; else to an older thread that it resembles; else it begins a thread. Long
threads are split, and old or surplus ones closed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Config:
    # Weights and limits of the assignment.
    w_semantic: float = 0.6
    w_time: float = 0.2
    w_social: float = 0.2
    w_tfidf: float = 0.45
    attach: float = 0.45
    margin: float = 0.02
    tau: float = 180.0
    max_open: int = 5
    close_hours: float = 12.0
    window: int = 20
    decay: float = 0.95
    b_gap: float = 0.4
    b_low: float = 0.6
    gap_norm: float = 360.0
    long_thread: int = 50
    min_part: int = 10
    short_gap: float = 5.0
    monologue_gap: float = 10.0
    monologue_floor: float = 0.15
    lookback_hours: float = 168.0
    reopen: float = 0.45
    split_threshold: float = 0.4


@dataclass
class Message:
    idx: int
    time: float  # seconds
    sender: str
    text: str
    vector: np.ndarray
    quote: tuple[str, str] | None = None
    reactors: tuple[str, ...] = ()
    terms: dict[str, float] = field(default_factory=dict)


@dataclass
class ThreadState:
    number: int
    ids: list[int]
    people: set[str]
    last_time: float
    last_sender: str
    start: float
    open: bool = True
    #: (last ids, their unit vectors, unit mean), made anew after a change
    recent: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    n = float(np.linalg.norm(a) * np.linalg.norm(b)) if len(a) and len(a) == len(b) else 0.0
    return float(a @ b) / n if n else 0.0


def unit(v: np.ndarray) -> np.ndarray:
    n = float(np.linalg.norm(v)) if len(v) else 0.0
    return v / n if n else v * 0.0


def sparse_cosine(a: dict[str, float], b: dict[str, float]) -> float:
    n = math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values()))
    return sum(x * b[t] for t, x in a.items() if t in b) / n if n else 0.0


class Assigner:
    def __init__(self, config: Config = Config()):
        self.c = config
        self.messages: dict[int, Message] = {}
        self.open: list[ThreadState] = []
        self.closed: list[ThreadState] = []
        self.thread_of: dict[int, ThreadState] = {}
        self.said: dict[tuple[str, str], list[int]] = {}
        self.n_threads = 0
        self.previous: Message | None = None
        self.decisions: list[tuple[int, str]] = []
        #: threads, last times, ids, vectors, means and first rows of the closed threads
        self._stack: tuple | None = None

    # -- similarity ------------------------------------------------------
    def _near(self, m: Message, t: ThreadState, of, mean, like) -> float:
        """The best likeness to a recent message, less the further back, or to their mean."""
        ids = t.ids[-self.c.window :]
        best = max((like(of(m), of(self.messages[i])) * self.c.decay ** abs(m.idx - i) for i in ids), default=0.0)
        return max(best, 0.0, like(of(m), mean(ids)))

    def dense(self, m: Message, t: ThreadState) -> float:
        """The same over vectors, with one product for all messages of the window."""
        ids, units, mean = self._recent(t)
        u = unit(m.vector)
        if not len(u) or units.shape[1:] != u.shape:
            return 0.0
        return max(0.0, float((units @ u * self.c.decay ** np.abs(m.idx - ids)).max()), float(mean @ u))

    def _recent(self, t: ThreadState) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if t.recent is None:
            ids = t.ids[-self.c.window :]
            rows = [self.messages[i].vector for i in ids]
            t.recent = (np.array(ids), np.array([unit(v) for v in rows]), unit(np.mean(rows, axis=0)))
        return t.recent

    def _best_closed(self, m: Message) -> tuple[ThreadState | None, float]:
        """The closed thread of the last ``lookback_hours`` most like the message, the first of equals, if any is like it.

        The recent vectors of all closed threads are one matrix, made anew after a thread was
        closed or reopened; threads whose vectors have no common size are compared one by one.
        """
        u = unit(m.vector)
        if not self.closed or not len(u):
            return None, 0.0
        if self._stack is None:
            kept = [(t, *self._recent(t)) for t in self.closed]
            same = [x for x in kept if x[2].shape[1:] == u.shape]
            if same:
                sizes = np.array([len(x[1]) for x in same])
                self._stack = (
                    [x[0] for x in same], np.array([x[0].last_time for x in same]), np.concatenate([x[1] for x in same]), np.concatenate([x[2] for x in same]),
                    np.stack([x[3] for x in same]), np.cumsum(sizes) - sizes,
                )
        if self._stack is None or self._stack[3].shape[1:] != u.shape:
            return None, 0.0
        threads, last, ids, units, means, first = self._stack
        near = np.maximum.reduceat(units @ u * self.c.decay ** np.abs(m.idx - ids), first)
        like = np.maximum(near, means @ u)
        like[m.time - last > 3600 * self.c.lookback_hours] = 0.0
        at = int(like.argmax())
        return (threads[at], float(like[at])) if like[at] > 0 else (None, 0.0)

    def semantic(self, m: Message, t: ThreadState) -> float:
        def merged(ids: list[int]) -> dict[str, float]:
            out: dict[str, float] = {}
            for i in ids:
                for k, v in self.messages[i].terms.items():
                    out[k] = out.get(k, 0.0) + v
            return out

        words = self._near(m, t, lambda x: x.terms, merged, sparse_cosine)
        return (1 - self.c.w_tfidf) * self.dense(m, t) + self.c.w_tfidf * words

    def score(self, m: Message, t: ThreadState) -> tuple[float, float]:
        """(attach score, semantic score)."""
        semantic = self.semantic(m, t)
        near = math.exp(-max(0.0, (m.time - t.last_time) / 60) / self.c.tau)
        same = 1.0 if m.sender == t.last_sender else 0.75 if m.sender in t.people else 0.0
        social = 0.6 * same + 0.4 * ((m.sender in t.people) / len(t.people | {m.sender}))
        if self.previous is not None and self.thread_of.get(self.previous.idx) is t:
            social = min(1.0, social + 0.25)
        return self.c.w_semantic * semantic + self.c.w_time * near + self.c.w_social * social, semantic

    # -- one message -----------------------------------------------------
    def add(self, m: Message) -> None:
        self.messages[m.idx] = m
        self._close_stale(m.time)
        quoted = self.said.get(m.quote, [])[-1:] if m.quote else []
        if quoted:
            thread, how = self.thread_of[quoted[0]], "quote"
            self._reopen(thread)
        else:
            thread, how = self._choose(m)
        if thread is None:
            self.n_threads += 1
            thread = ThreadState(self.n_threads, [], set(), m.time, m.sender, m.time)
            self.open.append(thread)
        thread.ids.append(m.idx)
        thread.recent = None
        thread.people |= {m.sender, *m.reactors}
        thread.last_time, thread.last_sender = m.time, m.sender
        self.thread_of[m.idx] = thread
        self.said.setdefault((m.sender, m.text), []).append(m.idx)
        self._split(thread)
        if how != "quote":
            while len(self.open) > self.c.max_open:
                oldest = min(self.open, key=lambda t: t.last_time)
                self._shut(oldest)
        self.decisions.append((m.idx, how))
        self.previous = m

    def _choose(self, m: Message) -> tuple[ThreadState | None, str]:
        before = self.previous
        if before is not None and before.sender == m.sender and max(0.0, m.time - before.time) <= 60 * self.c.monologue_gap:
            own = self.thread_of.get(before.idx)
            if own is not None and self.dense(m, own) >= self.c.monologue_floor:
                return own, "monologue"
        scored = [(*self.score(m, t), t) for t in self.open]
        gap = 1.0 if before is None else min(1.0, max(0.0, m.time - before.time) / 60 / self.c.gap_norm)
        fresh = self.c.b_gap * gap + self.c.b_low * (1 - max((s for _, s, _ in scored), default=0.0))
        if scored:
            ranked = sorted(scored, key=lambda x: -x[0])
            second = ranked[1][0] if len(ranked) > 1 else 0.0
            if ranked[0][0] >= self.c.attach and ranked[0][0] - second >= self.c.margin and ranked[0][0] > fresh:
                return ranked[0][2], "attach_open"
        best, most = self._best_closed(m)
        if best is not None and most >= self.c.reopen:
            self._reopen(best)
            return best, "reopen_closed"
        return None, "new_thread"

    # -- open and closed -------------------------------------------------
    def _shut(self, t: ThreadState) -> None:
        self.open = [x for x in self.open if x is not t]
        t.open = False
        self.closed.append(t)
        self._stack = None

    def _reopen(self, t: ThreadState) -> None:
        if not t.open:
            self.closed = [x for x in self.closed if x is not t]
            t.open = True
            self.open.append(t)
            self._stack = None

    def _close_stale(self, now: float) -> None:
        for t in [t for t in self.open if now - t.last_time >= 3600 * self.c.close_hours]:
            self._shut(t)

    def flush(self) -> None:
        """The end of a chat: all open threads are closed, in order."""
        for t in list(self.open):
            self._shut(t)

    # -- splits ----------------------------------------------------------
    def _components(self, ids: list[int]) -> dict[int, int]:
        """The quote component of each message of a thread."""
        root = {i: i for i in ids}

        def find(i: int) -> int:
            while root[i] != i:
                i = root[i]
            return i

        latest: dict[tuple[str, str], int] = {}
        for i in ids:
            m = self.messages[i]
            if m.quote in latest:
                root[find(latest[m.quote])] = find(i)
            latest[m.sender, m.text] = i
        return {i: find(i) for i in ids}

    def best_split(self, t: ThreadState) -> int | None:
        """The first best place after which to split, None if no place will do."""
        n = len(t.ids)
        if n <= self.c.long_thread or n < 2 * self.c.min_part:
            return None
        comp = self._components(t.ids)
        last_of = {c: k for k, c in enumerate(comp[i] for i in t.ids)}
        reach, best, most = -1, None, -math.inf
        for pos in range(n - self.c.min_part):
            reach = max(reach, last_of[comp[t.ids[pos]]])
            if pos < self.c.min_part - 1 or reach > pos:
                continue
            a, b = self.messages[t.ids[pos]], self.messages[t.ids[pos + 1]]
            gap = max(0.0, b.time - a.time) / 60
            value = 0.5 * min(1.0, gap / self.c.gap_norm) + 0.5 * (1 - cosine(a.vector, b.vector)) - 0.5 * (gap <= self.c.short_gap)
            if value > most:
                best, most = pos, value
        return best if best is not None and most >= self.c.split_threshold else None

    def _split(self, t: ThreadState) -> None:
        while (pos := self.best_split(t)) is not None:
            self.n_threads += 1
            ids = t.ids[pos + 1 :]
            t.ids = t.ids[: pos + 1]
            tail = ThreadState(self.n_threads, ids, set(), 0.0, "", 0.0, t.open)
            for part in (t, tail):
                own = [self.messages[i] for i in part.ids]
                part.recent = None
                part.people = {p for m in own for p in (m.sender, *m.reactors)}
                part.start, part.last_time, part.last_sender = own[0].time, own[-1].time, own[-1].sender
            for i in ids:
                self.thread_of[i] = tail
            (self.open if t.open else self.closed).append(tail)
            self._stack = None
            t = tail

    def rows(self) -> list[tuple[int, int, str]]:
        """(idx, thread number, decision) of all messages so far; splits change earlier ones."""
        return [(i, self.thread_of[i].number, how) for i, how in self.decisions]


COLUMNS = ("idx", "ts", "sender", "content", "vector", "quote_sender", "quote_text")
#: Columns that may be absent: weights of a message's terms (else their counts), and who reacted to it.
OPTIONAL = ("terms", "reactors")
RESULT = "chat_id string, idx bigint, thread_no int, decision string"


def _messages(frame: pd.DataFrame) -> Iterator[Message]:
    for r in frame.sort_values("idx", kind="stable").itertuples():
        given = getattr(r, "terms", None)
        words: dict[str, float] = dict(given) if given is not None else {}
        if given is None:
            for w in (r.content or "").lower().split():
                words[w] = words.get(w, 0.0) + 1.0
        people = getattr(r, "reactors", None)
        reactors = tuple(str(p) for p in people if p) if people is not None else ()
        quote = None if pd.isna(r.quote_sender) or pd.isna(r.quote_text) else (str(r.quote_sender), str(r.quote_text))
        vector = np.array([] if r.vector is None else r.vector, float)
        yield Message(int(r.idx), pd.Timestamp(r.ts).timestamp(), str(r.sender), r.content or "", vector, quote, reactors, words)


def _columns(messages: DataFrame) -> DataFrame:
    return messages.select("chat_id", *COLUMNS, *[c for c in OPTIONAL if c in messages.columns])


def with_term_weights(messages: DataFrame) -> DataFrame:
    """Messages with ``terms``: the tf-idf weight of each term over all messages (chat_id, idx, content)."""
    from pyspark.sql import functions as F

    from ..operators import similarity

    key = F.concat_ws(":", F.col("chat_id").cast("string"), F.col("idx").cast("string"))
    docs = messages.select(key.alias("key"), "content")
    counts = similarity.term_counts(docs, "key", "content")
    weights = similarity.tfidf(counts, similarity.term_stats(counts)).groupBy(F.col("key").alias("_key")).agg(F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("terms"))
    rows = messages.withColumn("_own", key)
    none = F.create_map().cast("map<string,double>")
    return rows.join(weights, rows["_own"] == weights["_key"], "left").withColumn("terms", F.coalesce("terms", none)).drop("_own", "_key")


def assign(messages: DataFrame, config: Config = Config()) -> DataFrame:
    """Threads of all messages. Chats are independent; a chat is one task's work, as each
    decision needs those before."""

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        state = Assigner(config)
        for m in _messages(frame):
            state.add(m)
        state.flush()
        out = pd.DataFrame(state.rows(), columns=["idx", "thread_no", "decision"])
        out.insert(0, "chat_id", str(key[0]))
        return out.astype({"idx": "int64", "thread_no": "int32"})

    return _columns(messages).groupBy("chat_id").applyInPandas(run, RESULT)


def assign_stream(messages: DataFrame, config: Config = Config()) -> DataFrame:
    """The same over a stream, in update mode: after each batch the rows of the chats it
    touched whose thread is new or has changed. State holds the whole chat, as a quote
    may reopen a thread of any age."""
    import pickle

    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        chat = pickle.loads(bytes(state.get[0])) if state.exists else Assigner(config)
        before = {i: n for i, n, _ in chat.rows()}
        for m in _messages(pd.concat(list(frames))):
            chat.add(m)
        chat._stack = None
        state.update((pickle.dumps(chat),))
        out = pd.DataFrame([r for r in chat.rows() if before.get(r[0]) != r[1]], columns=["idx", "thread_no", "decision"])
        out.insert(0, "chat_id", str(key[0]))
        yield out.astype({"idx": "int64", "thread_no": "int32"})

    return _columns(messages).groupBy("chat_id").applyInPandasWithState(
        run, RESULT, "state binary", "update", GroupStateTimeout.NoTimeout
    )
