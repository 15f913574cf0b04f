r"""Phrase collocation mining (operator 13) on a weighted de Bruijn graph.

Texts are lower-cased (A-Z), split at ``[.,;:!?\x0A-\x0D]`` into pieces and those
into words ``[^\x20\x09]+``.  Nodes of the graph are pairs of neighbouring words,
edges are grams of ``ORDER`` = 3 words from the pair of the first two to the pair
of the last two, weighted by their number.  Every word occurrence starts exactly
one gram: an edge, or a shorter one where its piece ends (the correction).

How it runs:

1. One narrow pass counts bytes and finds the words and pairs that are too
   frequent for one bucket (from every 16th slice; it only balances the work).
2. Tasks turn texts into 64-bit word numbers (of language and word), count their
   grams in batches and pack the distinct ones by bucket: by first word, for a
   frequent first word by pair, for a frequent pair by gram.  A word's spelling
   goes along once a batch.  Above ``FANOUT`` buckets, batches pass through
   coarser buckets first, merged and dealt again, so that messages stay long.
3. A bucket sums its grams.  Shorter counts are node flow: f(two words) is what
   leaves the node plus what ends there, f(word) what leaves all its nodes plus
   the pieces that end with it; the parts of frequent words and pairs are added
   up afterwards.  Counts below ``min_count`` stop here: they are in the flows, and
   no phrase that holds one can be a candidate.
4. Unary paths are compacted: an edge as heavy as its target's flow is the only
   one that enters it, one as heavy as its source's flow the only one that leaves
   it; where both meet, the edges join to one path (pointer doubling, at most
   ``BLOCK`` edges a row).
5. Candidates of three words are the windows of the paths; candidates of two
   words are the nodes between paths (a node inside one occurs only inside
   equally frequent longer phrases, which cover it).  Scores are decimals, exact
   beyond 64 bits.  The best of each language are found in salted parts first.

Two words with one number are about m*m / 2**65 likely for m different words;
if they are spelled in different batches the run stops with an error.

Defined results: null text is empty; null lang is ``und`` (and one group with a
literal ``und``); doc_id is not looked at, so repeated rows count each time; an
empty table gives no rows; ties are ordered by phrase, so ranks are the same on
every run; further columns, whatever their names, are not looked at.  A text
longer than a slice is read in slices that end between words; a word of more than
``LONG_WORD`` bytes is numbered by a digest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.llm.common import SLICE_BYTES, U64, mix, shuffle_partitions, slices, table, text_buffer, text_parts, words
from basketry.llm.suffix_tree import pack, unpack
from basketry.session import checkpoint_root

ORDER = 3
MIN_COUNT = 10
TOP = 2000
#: Text bytes of a bucket, about, and tokens of a batch.
BUCKET_BYTES = 6_000_000
BATCH_TOKENS = 500_000
#: Buckets that one batch is dealt to.
FANOUT = 1024
#: Every so many slices are looked at for frequent words; so many entries a task.
PROBE, PROBE_TOP = 16, 4096
BLOCK = 512
LONG_WORD = 65_536
SALTS = 32

_ENDS = b".,;:!?\n\x0b\x0c\r"
#: Lower-cased word bytes, 0 for separators (NUL counts as a word byte, as 32).
WORD = np.zeros(256, np.uint8)
for _b in range(256):
    if _b not in _ENDS and _b not in b" \t":
        WORD[_b] = _b + 32 if 65 <= _b <= 90 else (_b or 32)
IS_END = np.zeros(256, bool)
IS_END[list(_ENDS)] = True


# --------------------------------------------------------------------- tokens

def lang_number(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]


def parts_of(data: np.ndarray, limit: int = SLICE_BYTES):
    """(start, end) ranges of one long text that end at separators."""
    return text_parts(data, WORD == 0, limit)


def tokens(data: np.ndarray, off: np.ndarray):
    """(start, end, row, hash, piece) of the words; pieces are numbered from 0,
    the first one being what is there at the start of ``data``."""
    if len(data) > LONG_WORD and len(off) == 2 and not (WORD[data] == 0).any():
        h = np.frombuffer(hashlib.blake2b(WORD[data].tobytes(), digest_size=8).digest(), np.uint64)
        z = np.zeros(1, np.int64)
        return z, z + len(data), z, h, z
    start, end, row, h = words(data, off, WORD)
    for k in np.flatnonzero(end - start > LONG_WORD).tolist():
        h[k] = np.frombuffer(hashlib.blake2b(WORD[data[start[k]:end[k]]].tobytes(), digest_size=8).digest(), np.uint64)[0]
    piece = np.cumsum(IS_END[data])
    return start, end, row, h, (piece[start] if len(start) else start) + row


def spellings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, bytes) of the lower-cased words at these places."""
    n = end - start
    at = np.repeat(start - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    raw = data[at]
    return n, np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


class Batch:
    """Word numbers, pieces and new spellings of a task's texts, up to a flush."""

    def __init__(self):
        self.ids, self.piece = [], []
        self.n, self.base = 0, 0
        self.langs: dict[str, int] = {}
        self.counts: list[int] = []
        self.known = np.zeros(0, np.uint64)
        self.spelled = []

    def add(self, data: np.ndarray, off: np.ndarray, langs: list[str], goes_on: bool) -> None:
        """The rows of a slice; ``goes_on``: its first row began in the slice before."""
        start, end, row, h, piece = tokens(data, off)
        number = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs], np.int64)
        self.counts += [0] * (len(self.langs) - len(self.counts))
        per_row = np.bincount(row, minlength=len(langs))
        for k, n in zip(number.tolist(), per_row.tolist(), strict=True):
            self.counts[k] += n
        salt = np.array([lang_number(x) for x in langs], np.uint64)
        ids = mix(h ^ salt[row]) if len(h) else h
        ids[ids == 0] = 1
        self.ids.append(ids)
        first = self.base + (not goes_on)  # base: the number of the last piece
        self.piece.append(piece + first)
        self.base = first + int(IS_END[data].sum()) + len(langs) - 1
        self.n += len(ids)
        new, first = np.unique(ids, return_index=True)
        if len(new):
            at = np.searchsorted(self.known, new)
            seen = np.zeros(len(new), bool)
            inside = at < len(self.known)
            seen[inside] = self.known[at[inside]] == new[inside]
            new, first = new[~seen], first[~seen]
            self.known = np.sort(np.concatenate((self.known, new)))
            n, raw = spellings(data, start[first], end[first])
            self.spelled.append((new, number[row[first]], n, raw))

    def take(self, all_of_it: bool):
        """(h1, h2, h3, count), sorted and distinct, and the spellings.  Unless
        all of it is taken, two words stay, as grams may go on after them."""
        ids, piece = np.concatenate([np.zeros(0, np.uint64), *self.ids]), np.concatenate([np.zeros(0, np.int64), *self.piece])
        n = len(ids) if all_of_it else max(0, len(ids) - ORDER + 1)
        word = np.unique(np.concatenate((np.zeros(1, np.uint64), ids)))
        code = np.searchsorted(word, ids).astype(np.uint64)
        follow = []
        for k in range(1, ORDER):
            x = np.zeros(n, np.uint64)
            m = min(n, len(ids) - k)
            if m > 0:
                x[:m] = np.where(piece[:m] == piece[k:m + k], code[k:m + k], U64(0))
            follow.append(x)
        bits = max(1, int(len(word)).bit_length())
        if ORDER * bits <= 64:
            key = np.sort(code[:n] << U64(2 * bits) | follow[0] << U64(bits) | follow[1])
            new = np.ones(n, bool)
            new[1:] = key[1:] != key[:-1]
            at, key = np.flatnonzero(new), key[new]
            c = [key >> U64(2 * bits), key >> U64(bits) & U64((1 << bits) - 1), key & U64((1 << bits) - 1)]
            grams = [*(word[x] for x in c), np.diff(np.append(at, n))]
        else:
            grams = summed(*(word[x] for x in (code[:n], *follow)), np.ones(n, np.int64))
        spelled = [np.concatenate(x) for x in zip(*self.spelled, strict=True)] if self.spelled else [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)]
        langs, counts = list(self.langs), self.counts
        self.ids, self.piece, self.n = [ids[n:]], [piece[n:]], len(ids) - n
        self.known, self.spelled, self.langs, self.counts = np.zeros(0, np.uint64), [], {}, []
        return grams, spelled, langs, np.array(counts, np.int64)


def summed(h1, h2, h3, c) -> list[np.ndarray]:
    """Distinct grams in order, with the sums of their counts."""
    codes, bits = [], []
    for h in (h1, h2, h3):
        u, inv = np.unique(h, return_inverse=True)
        codes.append(inv.astype(np.uint64))
        bits.append(max(1, int(len(u)).bit_length()))
    if sum(bits) <= 64:
        key = codes[0] << U64(bits[1] + bits[2]) | codes[1] << U64(bits[2]) | codes[2]
        order = np.argsort(key)
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
    else:
        order = np.lexsort((h3, h2, h1))
        new = np.ones(len(order), bool)
        new[1:] = np.any([h[order][1:] != h[order][:-1] for h in (h1, h2, h3)], axis=0)
    at = np.flatnonzero(new)
    first = order[at]
    return [h1[first], h2[first], h3[first], np.add.reduceat(c[order], at) if len(at) else c[:0]]


def spelled_once(ids, lang, n, raw):
    """Distinct spellings; an error if two words have one number."""
    end = np.cumsum(n)
    order = np.argsort(ids, kind="stable")
    new = np.ones(len(ids), bool)
    new[1:] = ids[order][1:] != ids[order][:-1]
    if not new.all():
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))]
        rest = order[~new]
        same = head[~new]
        if (n[rest] != n[same]).any() or any(raw[end[a] - n[a]:end[a]].tobytes() != raw[end[b] - n[b]:end[b]].tobytes() for a, b in zip(rest.tolist(), same.tolist(), strict=True)):
            raise RuntimeError("two words share one 64-bit number")
    keep = order[new]
    at = np.repeat(end[keep] - n[keep] - np.concatenate(([0], np.cumsum(n[keep])[:-1])), n[keep]) + np.arange(n[keep].sum())
    return ids[keep], lang[keep], n[keep], raw[at]


# ------------------------------------------------------------------- exchange

class Deal:
    """The bucket of a gram: by first word; if that is frequent, by pair; if that
    is frequent too, by gram."""

    def __init__(self, buckets: int, hot_words: list[int], hot_pairs: list[int]):
        self.buckets = buckets
        self.words = np.sort(np.array(hot_words, np.uint64))
        self.pairs = np.sort(np.array(hot_pairs, np.uint64))

    def _in(self, h, hot) -> np.ndarray:
        if not len(hot):
            return np.zeros(len(h), bool)
        return hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h

    def hot_word(self, h1):
        return self._in(h1, self.words)

    def hot_pair(self, h1, h2):
        return self._in(pair(h1, h2), self.pairs) & self.hot_word(h1)

    def word(self, h1):
        return self._place(h1)

    def _place(self, h):
        return ((mix(h) >> U64(32)) * U64(self.buckets) >> U64(32)).astype(np.int64)

    def gram(self, h1, h2, h3):
        out, word = self._place(h1), self.hot_word(h1)
        if word.any():
            out[word] = self._place(pair(h1[word], h2[word]))
            both = self.hot_pair(h1, h2)
            out[both] = self._place(pair(pair(h1[both], h2[both]), h3[both]))
        return out


def pair(a, b):
    return mix(a ^ mix(b ^ U64(0xD6E8FEB86659FD93)))


MESSAGE = "bucket int, langs array<string>, data binary"


def messages(deal: Deal, div: int, grams, spelled, langs: list[str], counts: np.ndarray):
    """One row for each bucket (divided by ``div``) that the grams and spellings touch."""
    b = deal.gram(*grams[:3]) // div
    order = np.argsort(b, kind="stable")
    b = b[order]
    grams = [x[order] for x in grams]
    wb = deal.word(spelled[0]) // div
    worder = np.argsort(wb, kind="stable")
    wb, end = wb[worder], np.cumsum(spelled[2])
    rows = []
    for k in np.union1d(b, wb).tolist():
        z = slice(*np.searchsorted(b, [k, k + 1]))
        h1, h2, h3, c = (x[z] for x in grams)
        new1 = np.ones(len(h1), bool)
        new1[1:] = h1[1:] != h1[:-1]
        new2 = new1.copy()
        new2[1:] |= h2[1:] != h2[:-1]
        one, two = np.flatnonzero(new1), np.flatnonzero(new2)
        w = worder[slice(*np.searchsorted(wb, [k, k + 1]))]
        n = spelled[2][w]
        at = np.repeat(end[w] - n - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        total = counts if not rows else counts[:0]
        rows.append((k, langs, pack(
            np.diff(h1[one], prepend=U64(0)), np.diff(np.append(one, len(h1))).astype("<u4"), h2[two], np.diff(np.append(two, len(h1))).astype("<u4"), h3, c.astype("<u4") if not len(c) or c.max() < 1 << 32 else c.astype("<u8"),
            spelled[0][w], spelled[1][w].astype("<u2"), n.astype("<u4"), spelled[3][at], total.astype("<i8"))))
    cols = list(zip(*rows, strict=True)) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.list_(pa.string())), pa.array(cols[2], pa.binary())], ["bucket", "langs", "data"])


def opened(data: bytes):
    wide = int(np.frombuffer(data, "<i8", 13)[12])
    u1, n1, h2, n2, h3, c, ids, lang, n, raw, total = unpack(data, "<u8", "<u4", "<u8", "<u4", "<u8", f"<u{wide}", "<u8", "<u2", "<u4", np.uint8, "<i8")
    return (np.repeat(np.cumsum(u1), n1), np.repeat(h2, n2), h3, c.astype(np.int64)), (ids, lang.astype(np.int64), n.astype(np.int64), raw), total


def gathered(rows):
    """The sum of several messages: (grams, spellings, langs, counts)."""
    langs: dict[str, int] = {}
    grams, spelled, counts = [], [], {}
    for names, data in rows:
        g, (ids, lang, n, raw), total = opened(data)
        number = np.array([langs.setdefault(x, len(langs)) for x in names], np.int64)
        for x, c in zip(names, total.tolist(), strict=False):
            counts[x] = counts.get(x, 0) + c
        grams.append(g)
        spelled.append((ids, number[lang] if len(lang) else lang, n, raw))
    g = summed(*(np.concatenate(x) for x in zip(*grams, strict=True)))
    s = spelled_once(*(np.concatenate(x) for x in zip(*spelled, strict=True)))
    return g, s, list(langs), np.array([counts.get(x, 0) for x in langs], np.int64)


def _read(make, use, last, limit: int = SLICE_BYTES):
    """A narrow pass over (lang, text) batches: ``use`` gets the state and each
    slice, and yields; ``last`` yields at the end."""
    def run(batches):
        state = make()
        for b in batches:
            langs = ["und" if x is None else x for x in b.column(0).to_pylist()]
            data, off = text_buffer(b.column(1))
            for i, j in slices(off, limit):
                if j == i + 1 and off[j] - off[i] > limit:
                    text = data[off[i]:off[j]]
                    for a, z in parts_of(text, limit):
                        yield from use(state, text[a:z], np.array([0, z - a]), langs[i:j], a > 0)
                else:
                    yield from use(state, data[off[i]:off[j]], off[i:j + 1] - off[i], langs[i:j], False)
        yield from last(state)
    return run


def _probe():
    """Bytes, and the most frequent words and pairs of every ``PROBE``-th slice."""
    def use(s, data, off, langs, goes_on):
        s["bytes"] += len(data)
        s["slices"] += 1
        if s["slices"] % PROBE == 1:
            _, _, row, h, piece = tokens(data, off)
            if len(h):
                salt = np.array([lang_number(x) for x in langs], np.uint64)
                ids = mix(h ^ salt[row])
                ids[ids == 0] = 1
                s["n"] += len(ids)
                for kind, x in ((1, ids), (2, pair(ids[:-1], np.where(piece[1:] == piece[:-1], ids[1:], U64(0))))):
                    u, c = np.unique(np.concatenate((s[kind][0], x)), return_inverse=True)
                    c = np.bincount(c, np.concatenate((s[kind][1], np.ones(len(x)))), len(u))
                    if len(u) > 64 * PROBE_TOP:
                        top = np.argpartition(-c, 16 * PROBE_TOP)[:16 * PROBE_TOP]
                        u, c = u[top], c[top]
                    s[kind] = u, c
        return ()

    def last(s):
        kinds, keys, counts = [0, 3], [0, 0], [s["bytes"], s["n"]]
        for kind in (1, 2):
            u, c = s[kind]
            top = np.argsort(-c)[:PROBE_TOP]
            kinds += [kind] * len(top)
            keys += u[top].view(np.int64).tolist()
            counts += c[top].astype(np.int64).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["kind", "key", "n"])

    none = lambda: (np.zeros(0, np.uint64), np.zeros(0))
    return _read(lambda: {"bytes": 0, "slices": 0, "n": 0, 1: none(), 2: none()}, use, last)


def _count(deal: Deal, div: int, batch_tokens: int, limit: int = SLICE_BYTES):
    def use(s: Batch, data, off, langs, goes_on):
        s.add(data, off, langs, goes_on)
        if s.n >= batch_tokens:
            yield messages(deal, div, *s.take(False))

    def last(s: Batch):
        yield messages(deal, div, *s.take(True))

    return _read(Batch, use, last, limit)


def _regroup(deal: Deal, div: int, batch_tokens: int):
    """Messages of coarse buckets, summed up to a batch and dealt to finer ones."""
    def run(batches):
        rows, n, at = [], 0, None
        for b in batches:
            for k, langs, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if rows and (k != at or n >= batch_tokens):
                    yield messages(deal, div, *gathered(rows))
                    rows, n = [], 0
                at = k
                rows.append((langs, data))
                n += int(np.frombuffer(data, "<i8", 10)[9])
        if rows:
            yield messages(deal, div, *gathered(rows))
    return run


COUNTS = "kind int, a long, b long, c long, n long, word string, lang string"
LANG, WORDS, NODES, EDGES = 0, 1, 2, 3


def _flows(deal: Deal, min_count: int):
    """The sums of one bucket: language totals, words, nodes and edges."""
    def run(t: pa.Table) -> pa.Table:
        (h1, h2, h3, c), (ids, lang, n, raw), langs, totals = gathered(list(zip(t.column("langs").to_pylist(), t.column("data").to_pylist(), strict=True)))
        out = {k: [] for k in ("kind", "a", "b", "c", "n", "word", "lang")}

        def rows(kind, a, b, c, n, word=None, lang=None):
            m = len(n)
            out["kind"].append(np.full(m, kind, np.int32))
            for name, x in (("a", a), ("b", b), ("c", c)):
                out[name].append(np.zeros(m, np.int64) if x is None else x.view(np.int64))
            out["n"].append(n.astype(np.int64))
            out["word"] += word or [None] * m
            out["lang"] += lang or [None] * m

        some = np.flatnonzero(totals)
        rows(LANG, None, None, None, totals[some], lang=[langs[k] for k in some.tolist()])
        many = (c >= min_count) & (h3 != 0)
        rows(EDGES, h1[many], h2[many], h3[many], c[many])
        for kind, keys in ((NODES, (h1, h2)), (WORDS, (h1,))):
            new = np.ones(len(h1), bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            at = np.flatnonzero(new)
            flow = np.add.reduceat(c, at) if len(at) else c
            k = [x[at] for x in keys]
            if kind == NODES:
                keep = ((flow >= min_count) | deal.hot_pair(*k)) & (k[1] != 0)
                rows(NODES, k[0][keep], k[1][keep], None, flow[keep])
            else:
                # spelled here, flow here; of a frequent word also either without the other
                hot = deal.hot_word(ids)
                place = np.minimum(np.searchsorted(k[0], ids), max(0, len(k[0]) - 1))
                there = np.where(k[0][place] == ids, flow[place], 0) if len(flow) else np.zeros(len(ids), np.int64)
                keep = np.flatnonzero(hot | (there >= min_count))
                end = np.cumsum(n)
                rows(WORDS, ids[keep], None, None, there[keep], [raw[end[i] - n[i]:end[i]].tobytes().decode("utf-8", "replace") for i in keep.tolist()], [langs[lang[i]] for i in keep.tolist()])
                parts = deal.hot_word(k[0]) & ~np.isin(k[0], ids)
                rows(WORDS, k[0][parts], None, None, flow[parts])
        return pa.table({"kind": pa.array(np.concatenate(out["kind"]), pa.int32()), **{x: pa.array(np.concatenate(out[x]), pa.int64()) for x in ("a", "b", "c", "n")}, "word": pa.array(out["word"], pa.string()), "lang": pa.array(out["lang"], pa.string())})
    return run


def counted(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, bucket_bytes: int = BUCKET_BYTES, batch_tokens: int = BATCH_TOKENS, fanout: int = FANOUT) -> dict[str, DataFrame]:
    """Tables of all counts of ``min_count`` and more: totals (lang, n), words (id,
    word, lang, n), nodes (a, b, n) and edges (a, b, c, n) of word numbers."""
    spark = docs.sparkSession
    checkpoint_root(spark)
    src = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    # at most 2 * PROBE_TOP + 2 rows from each task, of which the shares below keep fewer than 8 for a bucket
    probe = src.mapInArrow(_probe(), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).checkpoint()
    size = {r.kind: r.n for r in probe.where("kind IN (0, 3)").collect()}
    buckets = max(1, -(-size.get(0, 0) // bucket_bytes))
    hot = probe.where(F.col("kind").isin(1, 2) & (F.col("n") * 4 * buckets >= size.get(3, 0)) & (F.col("n") > 1)).collect() if buckets > 1 else []
    deal = Deal(buckets, [r.key % (1 << 64) for r in hot if r.kind == 1], [r.key % (1 << 64) for r in hot if r.kind == 2])
    div = 1
    while -(-buckets // div) > fanout:
        div *= fanout
    sent = src.mapInArrow(_count(deal, div, batch_tokens), MESSAGE)
    while div > 1:
        width, div = -(-buckets // div), div // fanout
        sent = sent.repartition(max(width, shuffle_partitions(spark)), "bucket").sortWithinPartitions("bucket").mapInArrow(_regroup(deal, div, batch_tokens), MESSAGE)
    rows = sent.groupBy("bucket").applyInArrow(_flows(deal, min_count), COUNTS).checkpoint()
    of = lambda k: rows.where(F.col("kind") == k)
    enough = F.col("n") >= min_count
    return {
        "totals": of(LANG).groupBy("lang").agg(F.sum("n").alias("n")),
        "words": of(WORDS).groupBy(F.col("a").alias("id")).agg(F.max("word").alias("word"), F.max("lang").alias("lang"), F.sum("n").alias("n")).where(enough),
        "nodes": of(NODES).groupBy("a", "b").agg(F.sum("n").alias("n")).where(enough),
        "edges": of(EDGES).select("a", "b", "c", "n"),
    }


# ---------------------------------------------------------------------- paths

def compacted(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paths, junctions).  A path is a row (n, steps): the weight of all its
    edges, and for each edge its words a, b, c and the flows fa and fb of its
    source and target.  A junction is a node that no path passes through: (a, b,
    n, top), ``top`` the heaviest edge at it (0 if none)."""
    e = edges.join(nodes.withColumnRenamed("n", "fa"), ["a", "b"]).join(nodes.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("fb")), ["b", "c"])
    e = e.select(F.monotonically_increasing_id().alias("id"), "a", "b", "c", "n", "fa", "fb").checkpoint()
    # the only edge out of a node after the only edge into it
    before = e.where("n = fb").select(F.col("b").alias("x"), F.col("c").alias("y"), F.col("id").alias("prev"))
    after = e.where("n = fa").select(F.col("a").alias("x"), F.col("b").alias("y"), "id")
    link = before.join(after, ["x", "y"]).select("id", "prev")
    jump = e.join(link, "id", "left").select("id", F.coalesce("prev", "id").alias("head"), F.when(F.col("prev").isNull(), 0).otherwise(1).cast("long").alias("at")).checkpoint()
    while True:
        over = jump.where("at > 0").select("id", "head", "at").alias("s").join(jump.where("at > 0").alias("t"), F.col("s.head") == F.col("t.id"), "left")
        far = over.select(F.col("s.id").alias("id"), F.coalesce("t.head", "s.head").alias("head"), (F.col("s.at") + F.coalesce("t.at", F.lit(0))).alias("at"), F.col("t.id").isNotNull().alias("moved"))
        far = far.unionByName(jump.where("at = 0").select("id", "head", "at").withColumn("moved", F.lit(False))).checkpoint()
        jump = far.select("id", "head", "at")
        if not far.where("moved").limit(1).count():
            break
    step = F.struct("at", "a", "b", "c", "fa", "fb")
    paths = e.join(jump, "id").groupBy("head", F.expr(f"at div {BLOCK}").alias("part")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(step)).alias("steps")).select("n", "steps")
    ends = e.select("a", "b", F.col("n").alias("out"), F.lit(0).cast("long").alias("into")).unionByName(e.select(F.col("b").alias("a"), F.col("c").alias("b"), F.lit(0).cast("long").alias("out"), F.col("n").alias("into")))
    ends = ends.groupBy("a", "b").agg(F.max("out").alias("out"), F.max("into").alias("into"))
    j = nodes.join(ends, ["a", "b"], "left").where(~((F.col("out") == F.col("n")) & (F.col("into") == F.col("n"))) | F.col("out").isNull())
    return paths, j.select("a", "b", "n", F.coalesce(F.greatest("out", "into"), F.lit(0)).alias("top"))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts below 10**16."""
    d = lambda c: c.cast("decimal(16,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", (d(a) * d(a)).cast("decimal(32,0)") * million, d(left) * d(right))


def phrases(tables: dict[str, DataFrame], cover: tuple[int, int] = (100, 50)) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every candidate that no longer one
    covers: 100 * f(longer) >= 50 * a."""
    paths, junctions = compacted(tables["nodes"], tables["edges"])
    some = tables["words"].select("id", "word", "n", "lang").checkpoint()
    w = lambda k: some.select(F.col("id").alias(k), F.col("word").alias(f"w{k}"), F.col("n").alias(f"f{k}_"))
    three = paths.select("n", F.inline("steps")).join(w("a"), "a").join(w("c"), "c").join(some.select(F.col("id").alias("b"), F.col("word").alias("wb"), "lang"), "b")
    left, right = score(F.col("n"), F.col("fa_"), F.col("fb")), score(F.col("n"), F.col("fa"), F.col("fc_"))
    three = three.select("lang", F.concat_ws(" ", "wa", "wb", "wc").alias("phrase"), F.col("n").alias("a"), left.alias("s1"), right.alias("s2"), F.col("fa_").alias("l1"), F.col("fb").alias("r1"), F.col("fa").alias("l2"), F.col("fc_").alias("r2"))
    first = F.col("s1") <= F.col("s2")
    three = three.select("lang", "phrase", "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    two = junctions.where(F.col("top") * cover[0] < F.col("n") * cover[1]).join(w("a"), "a").join(some.select(F.col("id").alias("b"), F.col("word").alias("wb"), F.col("n").alias("r"), "lang"), "b")
    two = two.select("lang", F.concat_ws(" ", "wa", "wb").alias("phrase"), F.col("n").alias("a"), F.col("fa_").alias("l"), "r", score(F.col("n"), F.col("fa_"), F.col("r")).alias("score"))
    return two.unionByName(three).join(tables["totals"], "lang").select("lang", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language, with ``rank``; first inside salted
    parts, so that a task gets at most SALTS * top rows of a language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = found.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part = part.withColumn("_k", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_k") <= top)
    out = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13(spark, sf_dir: str) -> DataFrame:
    return best(phrases(counted(table(spark, sf_dir, "documents"))))


OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (
  SELECT lang, len(x) AS k, array_to_string(x, ' ') AS phrase, x, count(*) AS f
  FROM (SELECT lang, unnest([w[i:i], w[i:i+1], w[i:i+2]]) AS x, unnest([i, i + 1, i + 2]) AS last, len(w) AS n FROM i)
  WHERE last <= n GROUP BY lang, k, phrase, x),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM g WHERE k >= 2 AND f >= 10),
cover AS (
  SELECT lang, phrase, max(f) AS top FROM (
    SELECT lang, unnest([array_to_string(x[1:2], ' '), array_to_string(x[2:3], ' ')]) AS phrase, f FROM cand WHERE k = 3)
  GROUP BY lang, phrase),
cut AS (SELECT lang, phrase, k, x, f, unnest(CASE WHEN k = 2 THEN [1] ELSE [1, 2] END) AS c FROM cand),
s AS (
  SELECT cut.lang, cut.phrase, cut.k, cut.f AS a, c, gl.f AS l, gr.f AS r, (1000000::HUGEINT * cut.f * cut.f) // (gl.f::HUGEINT * gr.f) AS score
  FROM cut JOIN g gl ON gl.lang = cut.lang AND gl.phrase = array_to_string(cut.x[1:c], ' ')
           JOIN g gr ON gr.lang = cut.lang AND gr.phrase = array_to_string(cut.x[c+1:cut.k], ' ')),
m AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS pick FROM s),
r AS (
  SELECT m.lang, m.phrase, a, l, r, n, score::BIGINT AS score,
         row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, a DESC, m.phrase) AS rank
  FROM m JOIN total ON total.lang = m.lang LEFT JOIN cover ON cover.lang = m.lang AND cover.phrase = m.phrase AND m.k = 2
  WHERE pick = 1 AND coalesce(100 * top, 0) < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM r WHERE rank <= 2000
"""
