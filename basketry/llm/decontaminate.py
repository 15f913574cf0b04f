"""Benchmark decontamination (operator 10): an FM-index per training shard.

A shard is one slice of the training documents inside a task.  Its words
become integer ids of the benchmark's vocabulary; a word that no benchmark
item has ends a run, and runs shorter than the shortest window hold no window
and are left out, so the index covers exactly what can match.  Over the runs
the shard gets a suffix array (prefix doubling), its Burrows-Wheeler
transform, a wavelet tree with rank directories and sampled suffix positions.
All windows of the benchmark are searched backward at once; rows of the final
intervals are located by LF steps up to a sampled position.  Occurrences
become word spans, overlapping or touching spans are merged.

Defined results: null text has no words; an item without words has no window;
repeated items count once per ``item_id``; repeated document rows each get
their own result; empty tables give no rows or no hits; a null ``item_id``
counts as an item whose id is the empty string.
"""

from __future__ import annotations

from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import SLICE_BYTES, WORD_BYTES, free_name, map_text, sha_hex, slices, text_buffer, text_parts, text_slices, words

#: Words in a window.
WINDOW = 13
#: A document is contaminated if at least one word in this many is hit.
RATIO = 20
#: Benchmark text of one part; a part takes about 60 times as much memory while it
#: is made in the driver, and 10 times in a worker.
PART_BYTES = 1_000_000
#: Parts that one pass over the documents searches; a larger benchmark takes more passes.
PASS_PARTS = 8
#: Every so many text positions one suffix position is kept.
SAMPLE = 8


class Phrases:
    """Windows of the benchmark items, as ids of the items' vocabulary."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        texts = pa.array([t for _, t in items], pa.string())
        parts = []
        for i, _, data, off in text_slices(texts):
            _, _, row, h = words(data, off)
            parts.append((row + i, h))
        row = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        h = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint64)
        self.vocab, ids = np.unique(h, return_inverse=True)
        ids = ids.astype(np.int32)
        n = np.bincount(row, minlength=len(items))
        first = np.concatenate(([0], np.cumsum(n)))
        # one window at every start that leaves `window` words, or at the first word of a short item
        size = np.minimum(n, window)
        starts, owner = [], []
        for k in np.flatnonzero(n):
            starts.append(np.arange(first[k], first[k] + n[k] - size[k] + 1))
            owner.append(np.full(len(starts[-1]), k))
        starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        length = size[owner]
        # right-aligned, -1 to the left of short windows
        at = starts[:, None] + length[:, None] - window + np.arange(window)
        mat = np.where(at >= starts[:, None], ids[np.clip(at, 0, max(len(ids) - 1, 0))] if len(ids) else -1, -1)
        self.windows, inv = (np.unique(mat, axis=0, return_inverse=True) if len(mat)
                             else (np.zeros((0, window), np.int32), np.zeros(0, np.int64)))
        inv = inv.ravel()
        self.length = (self.windows >= 0).sum(1)
        self.shortest = int(self.length.min()) if len(self.length) else window
        pair = np.unique(np.stack([inv, owner], 1), axis=0) if len(inv) else np.zeros((0, 2), np.int64)
        self.owner_at = np.searchsorted(pair[:, 0], np.arange(len(self.windows) + 1))
        self.owner = pair[:, 1]
        self.ids = [k for k, _ in items]


class WaveletTree:
    """Level-wise wavelet tree (zeros of a level before its ones)."""

    def __init__(self, s: np.ndarray, top: int):
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            b = ((s >> bit) & 1).astype(bool)
            ones = np.zeros(len(s) + 1, np.int32)
            np.cumsum(b, out=ones[1:])
            zeros = int(len(s) - ones[-1])
            self.levels.append((bit, ones, zeros))
            s = np.concatenate((s[~b], s[b]))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before position i (both arrays)."""
        lo, hi = np.zeros_like(i), i.copy()
        for bit, ones, zeros in self.levels:
            b = ((c >> bit) & 1).astype(bool)
            olo, ohi = ones[lo], ones[hi]
            lo = np.where(b, zeros + olo, lo - olo)
            hi = np.where(b, zeros + ohi, hi - ohi)
        return hi - lo

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i and how often it stands before i."""
        c, lo, hi = np.zeros_like(i), np.zeros_like(i), i.copy()
        for bit, ones, zeros in self.levels:
            b = ones[hi + 1] > ones[hi]
            c = c | (b.astype(c.dtype) << bit)
            olo, ohi = ones[lo], ones[hi]
            lo = np.where(b, zeros + olo, lo - olo)
            hi = np.where(b, zeros + ohi, hi - ohi)
        return c, hi - lo


class FMIndex:
    """Over runs of ids >= 1; each run is followed by a separator 0.

    Separators sort by position, below all ids, so no suffix comparison goes
    past the end of its run.  Every run's first position is sampled, so that
    locating never steps over a separator.
    """

    def __init__(self, text: np.ndarray, run_starts: np.ndarray):
        n = len(text)
        sep = text == 0
        rank = np.where(sep, np.cumsum(sep) - 1, text + np.int64(sep.sum()))
        _, rank = np.unique(rank, return_inverse=True)
        rank = rank.ravel().astype(np.int64)
        k, sa = 1, None
        while True:
            nxt = np.full(n, -1, np.int64)
            nxt[:-k or None] = rank[k:] if k < n else nxt[:-k or None]
            key = rank * (n + 1) + nxt + 1
            sa = np.argsort(key, kind="stable")
            sk = key[sa]
            new = np.concatenate(([0], np.cumsum(sk[1:] != sk[:-1])))
            rank = np.empty(n, np.int64)
            rank[sa] = new
            if new[-1] == n - 1:
                break
            k *= 2
        bwt = text[sa - 1]  # the suffix at 0 is preceded by the last separator
        self.tree = WaveletTree(bwt.astype(np.int64), int(text.max()))
        self.count = np.concatenate(([0], np.cumsum(np.bincount(text))))
        kept = np.arange(n) % SAMPLE == 0
        kept[run_starts] = True
        self.at = np.where(kept[sa], sa, -1)  # sampled suffix positions by row
        self.n = n

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of all windows: (window, first row, end row)."""
        which = np.arange(len(windows))
        lo, hi = np.zeros(len(windows), np.int64), np.full(len(windows), self.n, np.int64)
        for j in range(windows.shape[1] - 1, -1, -1):
            c = windows[which, j].astype(np.int64)
            on = np.flatnonzero(c >= 0)
            if not len(on):
                break
            cc = c[on]
            ok = cc < len(self.count) - 1
            cc = np.where(ok, cc, 0)
            lo[on] = np.where(ok, self.count[cc] + self.tree.rank(cc, lo[on]), 0)
            hi[on] = np.where(ok, self.count[cc] + self.tree.rank(cc, hi[on]), 0)
            live = hi > lo
            which, lo, hi = which[live], lo[live], hi[live]
        return which, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps = np.empty(len(rows), np.int64), 0
        todo, row = np.arange(len(rows)), rows.copy()
        while len(todo):
            at = self.at[row]
            done = at >= 0
            out[todo[done]] = at[done] + steps
            todo, row = todo[~done], row[~done]
            if len(todo):
                c, r = self.tree.access_rank(row)
                row = self.count[c] + r
                steps += 1
        return out


def scan_slice(data: np.ndarray, off: np.ndarray, ph: Phrases):
    """For one shard: words per row, hit flag per word, word arrays, (row, item) pairs."""
    start, end, row, h = words(data, off)
    n_words = np.bincount(row, minlength=len(off) - 1)
    hit = np.zeros(len(h) + 1, np.int64)
    none = np.zeros((0, 2), np.int64)
    if not len(h) or not len(ph.windows):
        return n_words, hit[:-1] > 0, start, end, row, none
    at = np.minimum(np.searchsorted(ph.vocab, h), len(ph.vocab) - 1)
    known = ph.vocab[at] == h
    # runs of known words inside one row
    brk = np.concatenate(([True], (row[1:] != row[:-1]) | ~known[:-1] | ~known[1:]))
    run = np.cumsum(brk) - 1
    size = np.bincount(run)
    keep = np.flatnonzero(known & (size[run] >= ph.shortest))
    if not len(keep):
        return n_words, hit[:-1] > 0, start, end, row, none
    new = np.concatenate(([True], run[keep][1:] != run[keep][:-1]))
    k = np.cumsum(new) - 1  # separators before this word
    pos = np.arange(len(keep)) + k
    text = np.zeros(len(keep) + int(k[-1]) + 1, np.int64)
    text[pos] = at[keep] + 1
    word_at = np.full(len(text), -1, np.int64)
    word_at[pos] = keep
    fm = FMIndex(text, pos[new])
    which, lo, hi = fm.search(np.where(ph.windows >= 0, ph.windows + 1, -1))
    many = hi - lo
    which = np.repeat(which, many)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
    first = word_at[fm.locate(rows)]
    np.add.at(hit, first, 1)
    np.add.at(hit, first + ph.length[which], -1)
    pairs = np.unique(np.stack([row[first], which], 1), axis=0) if len(which) else none
    n_own = ph.owner_at[pairs[:, 1] + 1] - ph.owner_at[pairs[:, 1]]
    own_at = np.arange(n_own.sum()) - np.repeat(np.cumsum(n_own) - n_own, n_own) + np.repeat(ph.owner_at[pairs[:, 1]], n_own)
    items = np.unique(np.stack([np.repeat(pairs[:, 0], n_own), ph.owner[own_at]], 1), axis=0) if len(pairs) else none
    return n_words, np.cumsum(hit[:-1]) > 0, start, end, row, items


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
          T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", SPANS)]


def scan_parts(data: np.ndarray, off: np.ndarray, parts: list[Phrases]):
    """:func:`scan_slice` for several parts of the benchmark; pairs are (row, item id)."""
    hit, pairs = None, set()
    for ph in parts:
        n_words, h, start, end, row, found = scan_slice(data, off, ph)
        hit = h if hit is None else hit | h
        pairs |= {(r, ph.ids[k]) for r, k in found.tolist()}
    return n_words, hit, start, end, row, pairs


def scan_long(data: np.ndarray, parts: list[Phrases], window: int, limit: int):
    """The same for one long text, part by part; a part starts ``window`` - 1 words
    early, so that every window lies in one."""
    starts, ends, hits, items, early = [], [], [], set(), 0
    again = np.zeros(0, bool)                                     # of the words that the part before has, too
    n = len(data)
    for _, b in text_parts(data, WORD_BYTES == 0, limit):
        _, hit, start, end, _, pairs = scan_parts(data[early:b], np.array([0, b - early]), parts)
        items |= {k for _, k in pairs}
        hit[:len(again)] |= again
        done = len(start) if b == n else max(0, len(start) - window + 1)
        starts.append(start[:done] + early)
        ends.append(end[:done] + early)
        hits.append(hit[:done])
        again = hit[done:]
        early = early + int(start[done]) if done < len(start) else b
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return cat(starts, np.int64), cat(ends, np.int64), cat(hits, bool), items


def _scanner(bcs, window: int = WINDOW, limit: int = SLICE_BYTES):
    def make():
        parts = [bc.value for bc in bcs]

        def f(texts):
            n_words, n_hit, items, sizes, spans = [], [], [], [], []
            data, off = text_buffer(texts)
            for i, j in slices(off, limit):
                if off[j] - off[i] > limit:
                    start, end, hit, found = scan_long(data[off[i]:off[j]], parts, window, limit)
                    row, nw, pairs, at = np.zeros(len(start), np.int64), np.array([len(start)]), {(0, k) for k in found}, np.zeros(2, np.int64)
                else:
                    at = off[i:j + 1] - off[i]
                    nw, hit, start, end, row, pairs = scan_parts(data[off[i]:off[j]], at, parts)
                n_words.append(nw)
                n_hit.append(np.bincount(row[hit], minlength=j - i))
                mine = [set() for _ in range(j - i)]
                for r, k in pairs:
                    mine[r].add(k)
                items += [sorted(x) for x in mine]
                # removal spans: maximal runs of hit words of a row, in bytes of its text
                on = np.flatnonzero(hit)
                if len(on):
                    head = np.concatenate(([True], (on[1:] != on[:-1] + 1) | (row[on[1:]] != row[on[:-1]])))
                    tail = np.concatenate((head[1:], [True]))
                    r = row[on[head]]
                    spans.append((start[on[head]] - at[r], end[on[tail]] - at[r]))
                    sizes.append(np.bincount(r, minlength=j - i))
                else:
                    sizes.append(np.zeros(j - i, np.int64))
            cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            ends = np.concatenate(([0], np.cumsum(cat(sizes)))).astype(np.int32)
            st = pa.StructArray.from_arrays([pa.array(cat([s[q] for s in spans]), pa.int64()) for q in (0, 1)], ["start", "end"])
            return [pa.array(cat(n_words), pa.int64()), pa.array(cat(n_hit), pa.int64()),
                    pa.array(items, pa.list_(pa.string())), pa.ListArray.from_arrays(pa.array(ends), st)]
        return f
    return make


def _passes(benchmark: DataFrame, item: str, text: str, limit: int):
    """The benchmark's items in lists of at most ``limit`` bytes of text (one item at least)."""
    part, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("k"), F.col(text).alias("t")).where("t IS NOT NULL")
    for r in rows.orderBy("k", "t").toLocalIterator():
        n = len(r.t.encode())
        if part and size + n > limit:
            yield part
            part, size = [], 0
        part.append((r.k, r.t))
        size += n
    yield part


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None,
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  part_bytes: int | None = None, pass_parts: int | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) plus n_words, n_hit, items (sorted
    ids of items with an occurring window) and spans (merged removal spans, in
    bytes of the text's UTF-8).

    One narrow pass over the documents, without a shuffle, searches up to
    ``pass_parts`` parts of ``part_bytes`` of benchmark text; a larger benchmark
    takes more passes, matched by text.  A window of 13 words never spans two items,
    so parts are independent.
    """
    sc = docs.sparkSession.sparkContext
    keep = docs.columns if keep is None else keep
    part_bytes, pass_parts = part_bytes or PART_BYTES, pass_parts or PASS_PARTS
    made = (sc.broadcast(Phrases(p, window)) for p in _passes(benchmark, item, item_text, part_bytes))
    passes = iter(lambda: list(islice(made, pass_parts)), [])
    first, second = next(passes), next(passes, None)
    if second is None:
        return map_text(docs, text, keep, FIELDS, _scanner(first, window))
    own = free_name(docs.columns, "_own_text")  # later passes match by the text, whether it is kept or not
    docs = docs.withColumn(own, F.col(f"`{text}`").cast("string"))
    out = map_text(docs, own, [*keep, own], FIELDS, _scanner(first, window))
    for more in chain([second], passes):
        out = _another_pass(out, docs, own, _scanner(more, window))
    return out.drop(own)


def _another_pass(out, docs, text, scanner):
    """Adds the hits of one more part of the benchmark to an earlier result.

    Rows are matched by the text itself (its digest): equal texts have equal hits."""
    names = out.columns[-4:]
    more = map_text(docs.select(F.col(text)).distinct(), text, [text], FIELDS, scanner)
    more = more.select(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("_d"), *(F.col(f.name).alias(f"_{f.name}") for f in FIELDS)).dropDuplicates(["_d"])
    both = out.withColumn("_d", F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).join(more, "_d", "left")
    merged = merge_spans(F.concat(F.col(names[3]), F.coalesce(F.col("_spans"), F.array().cast(SPANS))))
    both = both.withColumns({names[2]: F.array_sort(F.array_union(F.col(names[2]), F.coalesce(F.col("_items"), F.array().cast("array<string>")))),
                             names[3]: merged})
    both = both.withColumn(names[1], span_words(F.col(text), F.col(names[3])))
    return both.select(*out.columns)


def merge_spans(spans):
    """Sorted union of byte spans."""
    def step(acc, x):
        last = F.element_at(acc, -1)
        head = F.slice(acc, 1, F.size(acc) - 1)
        return (F.when(F.size(acc) == 0, F.array(x))
                .when(x["start"] <= last["end"],
                      F.concat(head, F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end")))))
                .otherwise(F.concat(acc, F.array(x))))
    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), step)


def span_words(text, spans):
    """Words of the text inside the spans."""
    cut = F.transform(spans, lambda s: F.substring(text.cast("binary"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")).cast("string"))
    n = F.transform(cut, lambda c: F.size(F.filter(F.split(c, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != "")).cast("long"))
    return F.aggregate(n, F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated(n_hit, n_words, ratio: int = RATIO):
    return (n_hit > 0) & (n_hit * ratio >= n_words)


def op10(spark, sf_dir: str) -> DataFrame:
    from basketry.llm.common import table
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    r = decontaminate(docs, bench, keep=["doc_id"])
    return r.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


#: DuckDB: windows as strings of words joined by blanks.
OP10_SQL = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), 13) AS k FROM items WHERE len(w) > 0),
starts AS (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM sized),
windows AS (SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS gram FROM starts),
lens AS (SELECT DISTINCT k FROM windows),
places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM lowered, lens WHERE len(w) >= k),
found AS (SELECT DISTINCT p.doc_id, p.s, p.k, x.item FROM places p JOIN windows x ON x.k = p.k AND x.gram = array_to_string(p.w[p.s:p.s + p.k - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS pos FROM found) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT l.doc_id, CAST(len(l.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(o.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(o.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(l.w) AS contaminated
FROM lowered l LEFT JOIN hit h ON h.doc_id = l.doc_id LEFT JOIN own o ON o.doc_id = l.doc_id
"""
