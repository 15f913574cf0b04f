r"""LM scoring (operator 6): a probabilistic suffix tree over words.

Tokens: words ``[^\x20\x09-\x0D]+`` after A-Z have been lower-cased, then one
end token per text.  The root predicts a token by its add-one smoothed count.
A context of one or two tokens is a state of the tree if it passes a
divergence test against its parent, the longest shorter state: the sum over
its next tokens of n * ln(P(next | context) / P(next | parent)), with every
occurrence predicted from all the others (leave-one-out), has to be positive;
a token seen once after the context is then predicted by the parent alone.
A state's next-symbol distribution is smoothed with its parent by absolute
discounting.  A token is scored by the longest suffix of its history that is
a state.  All counts are over all training texts.

How it runs: tasks turn their texts into batches of token numbers (the most
frequent first, compressed), written once to the shared checkpoint folder.  A batch never sends tokens, only its
distinct n-gram keys with partial counts, packed by key range.  A range sums
them over all batches and answers each sender in the order of its keys
(:func:`_totals`), with a mark for the first sender, which alone adds an
n-gram to the statistics of its context.  Four passes: unigrams and bigrams;
statistics of one-word contexts, and trigrams of repeated bigrams; statistics
of two-word contexts; scores.  Keys are 40 bits below their range's bits, so
that accidental equals are about one in a million at every size.

Defined results: null text is empty (only the end token); a null doc_id is in
training; repeated rows each get a score; an empty table gives no rows; with
no training text every token has probability 1 / (0 + 0 + 1) at the root.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import MIX, TOKEN_BYTES, U64, crc_mod, mix, release, short_shuffles, table, text_slices, words
from basketry.session import checkpoint_root

DISCOUNT = 0.7
#: Text bytes of a batch, and of a key range, about.
BATCH_BYTES = 8_000_000
RANGE_BYTES = 8_000_000
END = mix(np.array([0xE0D], np.uint64))[0]
MESSAGE = "topic int, part int, b long, data binary"
UNI, BI, CTX1, TRI, CTX2 = 1, 2, 3, 4, 5


# ------------------------------------------------------------------- packing

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, byte planes apart."""
    parts, head = [], [len(arrays)]
    for x in arrays:
        x = np.ascontiguousarray(x)
        parts.append(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() if len(x) else b"")
        head += [len(x), x.itemsize]
    raw = b"".join(parts)
    return np.array([*head, len(raw)], "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(b: bytes, *kinds) -> list[np.ndarray]:
    n = int(np.frombuffer(b, "<i8", 1)[0])
    head = np.frombuffer(b, "<i8", 2 * n + 2)
    raw = np.frombuffer(pa.decompress(b[16 * n + 16:], decompressed_size=int(head[-1]), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for k, kind in enumerate(kinds):
        m, z = int(head[1 + 2 * k]), int(head[2 + 2 * k])
        out.append(np.ascontiguousarray(raw[at:at + m * z].reshape(z, m).T).view(kind).ravel() if m else np.zeros(0, kind))
        at += m * z
    return out


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, index of one occurrence of each, number of each element)."""
    order = np.argsort(h)
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    inv = np.empty(len(s), np.int64)
    inv[order] = np.cumsum(new) - 1
    return s[new], order[new], inv


def _parts(keys: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.array([0, len(keys)])
    return np.append(np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << U64(64 - bits)), len(keys))


def _messages(topic: int, b: int, keys: np.ndarray, bits: int, *columns: np.ndarray) -> list[tuple]:
    """One row per key range that the sorted keys touch."""
    cut = _parts(keys, bits)
    low = (keys << U64(bits)) >> U64(24)
    out = []
    for k in np.flatnonzero(np.diff(cut)):
        z = slice(cut[k], cut[k + 1])
        step = np.diff(low[z], prepend=U64(0))
        step = step.astype("<u4") if int(step.max()) < 1 << 32 else step
        out.append((topic, int(k), b, pack(step, *(c[z] for c in columns))))
    return out


def _table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else ((),) * 4
    return pa.table({"topic": pa.array(cols[0], pa.int32()), "part": pa.array(cols[1], pa.int32()), "b": pa.array(cols[2], pa.int64()), "data": pa.array(cols[3], pa.binary())})


KINDS = {UNI: ("<u4",), BI: ("<u4",), TRI: ("<u4",), CTX1: ("<f4", "<u4", "<u4"), CTX2: ("<f4", "<u4", "<u4")}


def _totals(key, t):
    """Sums of one topic's columns over all senders of one key range, returned
    to each sender in the order of its keys; counts also with the first-sender
    mark.  A row for sender -1 holds how many keys have a count, and all counts."""
    topic, part = key[0].as_py(), key[1].as_py()
    order = np.argsort(t.column("b").to_numpy(), kind="stable")
    senders = t.column("b").to_numpy()[order]
    data = t.column("data").to_pylist()
    keys, cols = [], [[] for _ in KINDS[topic]]
    for i in order:
        wide = int(np.frombuffer(data[i], "<i8", 3)[2])
        step, *rest = unpack(data[i], f"<u{wide}", *KINDS[topic])
        keys.append(np.cumsum(step.astype(np.uint64)))
        for c, x in zip(cols, rest, strict=True):
            c.append(x)
    ends = np.cumsum([len(k) for k in keys])
    uniq, first, inv = _first(np.concatenate(keys))
    sums = [np.bincount(inv, np.concatenate(c), len(uniq)) for c in cols]
    back = [s[inv] for s in sums]
    own = np.zeros(len(inv), np.uint8)
    own[first] = 1
    rows = []
    for i, b in enumerate(senders):
        z = slice(ends[i] - len(keys[i]), ends[i])
        if topic in (CTX1, CTX2):
            rows.append((topic, part, int(b), pack(back[0][z].astype("<f4"), back[1][z].astype("<u4"), back[2][z].astype("<u4"))))
        else:
            rows.append((topic, part, int(b), pack(back[0][z].astype("<u4"), np.packbits(own[z]))))
    if topic == UNI:
        rows.append((topic, part, -1, pack(np.array([np.count_nonzero(sums[0]), sums[0].sum()], "<i8"))))
    return _table(rows)


def _first(k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`distinct`, with the first occurrence of each key."""
    order = np.argsort(k, kind="stable")
    s = k[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    inv = np.empty(len(s), np.int64)
    inv[order] = np.cumsum(new) - 1
    return s[new], order[new], inv


def _answers(right: pa.Table, topic: int, n: int, *kinds, marks: bool = False) -> list[np.ndarray]:
    """A topic's answers to one sender, put together in key order."""
    on = right.filter(pa.array(right.column("topic").to_numpy() == topic))
    order = np.argsort(on.column("part").to_numpy())
    data = on.column("data").to_pylist()
    got = []
    for i in order:
        x = unpack(data[i], *kinds, *((np.uint8,) if marks else ()))
        if marks:
            x[-1] = np.unpackbits(x[-1], count=len(x[0])).astype(bool)
        got.append(x)
    out = [np.concatenate([g[q] for g in got]) if got else np.zeros(0, kinds[q] if q < len(kinds) else bool) for q in range(len(kinds) + marks)]
    if len(out[0]) != n:
        raise RuntimeError(f"{len(out[0])} answers for {n} keys of topic {topic}")
    return out


# --------------------------------------------------------------------- batches

class Batch:
    """Token grams of a batch and what is known of them so far."""

    @staticmethod
    def pack(h: np.ndarray, bits: int, lens, ids, null, held) -> bytes:
        """Token hashes to numbers by frequency; of the hashes only what messages carry stays."""
        low = U64(24 - min(bits, 24))
        k, _, inv = distinct(h >> low)
        n = np.bincount(inv, minlength=len(k))
        rank = np.empty(len(k), np.int64)
        rank[np.argsort(-n, kind="stable")] = np.arange(len(k))
        return pack(np.array([low], "<u8"), np.diff(k, prepend=U64(0)), n.astype("<u4"), rank[inv].astype("<u4"), lens.astype("<u4"), ids.astype("<i8"), null.astype(np.uint8), held.astype(np.uint8))

    def __init__(self, data: bytes):
        low, step, n, rank, lens, self.ids, self.null, self.held = unpack(data, "<u8", "<u8", "<u4", "<u4", "<u4", "<i8", np.uint8, np.uint8)
        self.k1, self.lens = np.cumsum(step) << low[0], lens.astype(np.int64)
        self.n1 = np.argsort(-n.astype(np.int64), kind="stable")[rank]
        self.row = np.repeat(np.arange(len(self.lens)), self.lens)
        first = np.cumsum(self.lens) - self.lens
        self.pos = np.arange(len(self.n1)) - first[self.row]
        self.train = self.held[self.row] == 0

    def bigrams(self):
        h = self.k1[self.n1]
        self.at2 = np.flatnonzero(self.pos >= 1)
        self.g2 = mix(h[self.at2] ^ (h[self.at2 - 1] * MIX))
        self.k2, self.some2, self.n2 = distinct(self.g2)
        self.of2 = np.full(len(h), -1, np.int64)  # bigram number of each token
        self.of2[self.at2] = self.n2

    def counted(self, right: pa.Table):
        self.c1, self.own1 = _answers(right, UNI, len(self.k1), "<u4", marks=True)
        self.c2, self.own2 = _answers(right, BI, len(self.k2), "<u4", marks=True)
        self.c1, self.c2 = self.c1.astype(np.float64), self.c2.astype(np.float64)

    def trigrams(self):
        """After a bigram seen twice in training, ending in one seen there; no
        other trigram's count matters to a state."""
        n2 = np.where(self.of2 >= 0, self.c2[self.of2], 0) if len(self.c2) else np.zeros(len(self.of2))
        before = np.concatenate(([0], n2[:-1])) if len(n2) else n2
        self.at3 = np.flatnonzero((self.pos >= 2) & (before >= 2) & (n2 >= 1))
        g = mix(self.k2[self.of2[self.at3]] ^ mix(self.k1[self.n1[self.at3 - 2]] * MIX + U64(3)))
        self.k3, self.some3, self.n3 = distinct(g)

    def root(self, total: int, kinds: int):
        self.p0 = (self.c1 + 1.0) / (total + kinds + 1.0)

    def states1(self, right: pa.Table):
        """Which tokens are states, and how many different tokens follow them."""
        self.ctx1 = self.c1 >= 2
        s, m, r = _answers(right, CTX1, int(self.ctx1.sum()), *KINDS[CTX1])
        self.kinds1, self.state1 = np.zeros(len(self.k1)), np.zeros(len(self.k1), bool)
        self.kinds1[self.ctx1], self.state1[self.ctx1] = _retained(self.c1[self.ctx1], s, m, r)

    def states2(self, right: pa.Table):
        self.ctx2 = self.c2 >= 2
        s, m, r = _answers(right, CTX2, int(self.ctx2.sum()), *KINDS[CTX2])
        self.kinds2, self.state2 = np.zeros(len(self.k2)), np.zeros(len(self.k2), bool)
        self.kinds2[self.ctx2], self.state2[self.ctx2] = _retained(self.c2[self.ctx2], s, m, r)

    def parent(self, i: np.ndarray) -> np.ndarray:
        """Probability of the tokens at i by the root or a one-word state."""
        p = self.p0[self.n1[i]]
        u = np.where(self.pos[i] >= 1, self.n1[np.maximum(i - 1, 0)], -1)
        on = np.flatnonzero((u >= 0) & self.state1[np.maximum(u, 0)])
        n, uo = self.c2[self.of2[i[on]]], u[on]
        p[on] = (np.maximum(n - DISCOUNT, 0) + DISCOUNT * self.kinds1[uo] * p[on]) / self.c1[uo]
        return p


def _retained(n: np.ndarray, gain: np.ndarray, repeated: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different next tokens, divergence test passed) of contexts seen n times."""
    once = np.maximum(n - repeated, 0)
    every = kinds + once
    with np.errstate(divide="ignore"):
        test = gain + np.where(once > 0, once * np.log(DISCOUNT * np.maximum(every - 1, 1e-9) / np.maximum(n - 1, 1)), 0)
    return every, (test > 0) & (kinds > 0)


def _gain(n: np.ndarray, of: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Leave-one-out divergence of next tokens seen n >= 2 times in a context seen ``of`` times."""
    return n * np.log((n - 1 - DISCOUNT) / (of - 1) / parent)


def _numbered(bits: int):
    """Texts to batches."""
    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        hashes, lens, ids, held, size = [], [], [], [], 0

        def flush():
            nonlocal hashes, lens, ids, held, size, seq
            i = pa.concat_arrays(ids)
            state = Batch.pack(np.concatenate(hashes), bits, np.concatenate(lens), np.asarray(i.fill_null(0)), np.asarray(i.is_null()), np.concatenate(held))
            b = (part << 24) + seq
            hashes, lens, ids, held, size = [], [], [], [], 0
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([state], pa.binary())], ["b", "data"])

        for batch in batches:
            for i, j, data, off in text_slices(batch.column(1)):
                _, _, row, h = words(data, off, TOKEN_BYTES)
                n = np.bincount(row, minlength=j - i) + 1
                tok = np.full(n.sum(), END)
                tok[np.arange(len(h)) + row] = h
                hashes.append(tok)
                lens.append(n)
                ids.append(batch.column(0).slice(i, j - i))
                held.append(np.asarray(batch.column(2).slice(i, j - i)))
                size += len(data) + 8 * (j - i)
                if size >= BATCH_BYTES:
                    yield flush()
        if hashes:
            yield flush()
    return run


def _pass1(bits: int):
    """Unigram and bigram counts of the batches."""
    def run(batches):
        for batch in batches:
            for b, state in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = Batch(state)
                x.bigrams()
                rows = _messages(UNI, b, x.k1, bits, np.bincount(x.n1, x.train, len(x.k1)).astype("<u4"))
                rows += _messages(BI, b, x.k2, bits, np.bincount(x.n2, x.train[x.at2], len(x.k2)).astype("<u4"))
                yield from _table(rows).to_batches()
    return run


def _pass2(bits, total, kinds):
    def f(key, left, right):
        b = key[0].as_py()
        out = []
        for state in left.column("data").to_pylist():
            x = Batch(state)
            x.bigrams()
            x.counted(right)
            x.root(total, kinds)
            own = np.flatnonzero(x.own2 & (x.c2 >= 2))
            at = x.at2[x.some2[own]]
            u, n = x.n1[at - 1], x.c2[own]
            g = _gain(n, x.c1[u], x.p0[x.n1[at]])
            m = len(x.k1)
            on = x.c1 >= 2
            out += _messages(CTX1, b, x.k1[on], bits, np.bincount(u, g, m)[on].astype("<f4"), np.bincount(u, n, m)[on].astype("<u4"), np.bincount(u, minlength=m)[on].astype("<u4"))
            x.trigrams()
            out += _messages(TRI, b, x.k3, bits, np.bincount(x.n3, x.train[x.at3], len(x.k3)).astype("<u4"))
        return _table(out)
    return f


def _known(x: Batch, right, total, kinds):
    x.bigrams()
    x.counted(right)
    x.root(total, kinds)
    x.trigrams()
    x.states1(right)
    x.c3, x.own3 = _answers(right, TRI, len(x.k3), "<u4", marks=True)
    x.c3 = x.c3.astype(np.float64)


def _pass3(bits, total, kinds):
    def f(key, left, right):
        b = key[0].as_py()
        out = []
        for state in left.column("data").to_pylist():
            x = Batch(state)
            _known(x, right, total, kinds)
            own = np.flatnonzero(x.own3 & (x.c3 >= 2))
            at = x.at3[x.some3[own]]
            s, n = x.of2[at - 1], x.c3[own]
            g = _gain(n, x.c2[s], x.parent(at)) if len(at) else np.zeros(0)
            m = len(x.k2)
            on = x.c2 >= 2
            out += _messages(CTX2, b, x.k2[on], bits, np.bincount(s, g, m)[on].astype("<f4"), np.bincount(s, n, m)[on].astype("<u4"), np.bincount(s, minlength=m)[on].astype("<u4"))
        return _table(out)
    return f


def _scores(total, kinds):
    def f(key, left, right):
        parts = []
        for state in left.column("data").to_pylist():
            x = Batch(state)
            _known(x, right, total, kinds)
            x.states2(right)
            every = np.arange(len(x.n1))
            p = x.parent(every)
            s = np.where(x.pos >= 2, np.concatenate(([-1], x.of2[:-1])), -1)
            on = np.flatnonzero((s >= 0) & x.state2[np.maximum(s, 0)]) if len(x.k2) else np.zeros(0, np.int64)
            n3 = np.zeros(len(x.n1))
            n3[x.at3] = x.c3[x.n3]
            so = s[on]
            p[on] = (np.maximum(n3[on] - DISCOUNT, 0) + DISCOUNT * x.kinds2[so] * p[on]) / x.c2[so]
            first = np.cumsum(x.lens) - x.lens
            add = lambda v: np.add.reduceat(v, first)  # noqa: B023, E731
            parts.append(pa.table({"doc_id": pa.array(x.ids, mask=x.null.astype(bool)), "held_out": pa.array(x.held.astype(bool)), "n_tokens": pa.array(x.lens),
                                   "n_known": pa.array(add((x.c1 > 0)[x.n1].astype(np.int64))), "base_score": pa.array(add(np.log10(x.p0)[x.n1])), "score": pa.array(add(np.log10(p)))}))
        return pa.concat_tables(parts)
    return f


def score_texts(docs: DataFrame, is_training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (root only), score of every row."""
    spark = docs.sparkSession
    checkpoint_root(spark)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = max(0, (-(-size // RANGE_BYTES) - 1).bit_length())
    src = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t"), (~F.coalesce(is_training, F.lit(True))).alias("h"))
    by_batch = lambda answers, f, schema: state.groupBy("b").cogroup(answers.where("b >= 0").groupBy("b")).applyInArrow(f, schema)

    settle = lambda messages: messages.groupBy("topic", "part").applyInArrow(_totals, MESSAGE).checkpoint()
    state = src.mapInArrow(_numbered(bits), "b long, data binary").checkpoint()
    with short_shuffles(spark):
        one = settle(state.mapInArrow(_pass1(bits), MESSAGE))
        release(spark)
        sums = [unpack(bytes(r.data), "<i8")[0] for r in one.where("b = -1").select("data").toLocalIterator()]
        kinds, total = (int(sum(s[q] for s in sums)) for q in (0, 1))
        two = settle(by_batch(one, _pass2(bits, total, kinds), MESSAGE))
        release(spark)
        three = settle(by_batch(one.union(two), _pass3(bits, total, kinds), MESSAGE))
        release(spark)
    out = by_batch(one.union(two).union(three), _scores(total, kinds), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op6(spark, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) != 2)
