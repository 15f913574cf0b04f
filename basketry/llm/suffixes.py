"""Suffix-array dedup (operator 7): bytes of earlier documents' 50-byte strings
are removed.

A full suffix array of the corpus would be many times its size, so it is
sparse: of each 50-byte window only its minimizer is indexed, the position
whose 16-byte gram has the least hash among the window's 35.  Equal windows
have the same minimizer at the same offset, so no match is lost.

1. Texts that are equal as a whole are represented by the smallest doc_id; all
   of any other copy is removed (if it has 50 bytes).
2. Documents are spread over batches by a hash of their id.  Each batch sends
   the distinct hashes of its minimizers, packed by hash range, and gets back
   one bit per hash: whether another document has it too.
3. The suffixes at such positions (50 bytes, and the 34 bytes before them) are
   range-partitioned by their leading bytes through sampled splitters.  Equal
   contexts of one batch travel once; what a batch sends to a bucket is one
   compressed row.  Every bucket is sorted by a multikey quicksort over 8-byte
   characters.  Within a bucket each of the 35 windows of a suffix gets the
   smallest doc_id that has it, and its occurrences in larger ones become spans.
4. Across boundaries: suffixes whose gram is the first or last of a bucket may
   continue in the next one.  Their windows' smallest occurrences (one per
   window and bucket, as larger ones are settled already) meet by a hash of
   the window, which also spreads a gram that a third of all rows has.
5. Each batch cuts the spans out of its documents.

All steps are one lazy plan; the shuffle of the texts by batch is reused.

Defined results: null text is empty; a null doc_id counts as larger than all
others; rows of the same doc_id never count against each other; repeated rows
get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import MIX, U64, free_name, lean_group, mix, table, text_buffer

LENGTH = 50
GRAM = 16
SPAN = LENGTH - GRAM + 1  # grams in a window
LEFT = SPAN - 1
#: Text bytes of a batch, of a hash range, and of a bucket of suffixes, about.
BATCH_BYTES = 8_000_000
RANGE_BYTES = 16_000_000
BUCKET_BYTES = 4_000_000
#: Text sampled for the splitters, per bucket.
SAMPLE_BYTES = 16_000
_POS = U64(30)
_CHUNK = 500_000
_POW = np.cumprod(np.concatenate(([U64(1)], np.full(LEFT + LENGTH, U64(0x2545F4914F6CDD1D)))))
_INV = np.cumprod(np.concatenate(([U64(1)], np.full(LEFT + LENGTH, U64(pow(0x2545F4914F6CDD1D, -1, 1 << 64))))))


def _words64(b: np.ndarray, n: int, at: int) -> np.ndarray:
    """The 8 bytes from each of the positions at..at+n-1, as integers."""
    return np.ndarray((n,), "<u8", b, at, (1,)).copy()


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all minimizers of a batch's windows, and their 64-bit hashes."""
    end = np.repeat(off[1:], np.diff(off))
    pos, hashes = [], []
    for a in range(0, max(len(data) - LENGTH + 1, 0), _CHUNK):
        n = min(_CHUNK, len(data) - LENGTH + 1 - a)  # windows
        b = data[a:a + n + LENGTH - 1]
        g = n + SPAN - 1  # grams
        b = np.ascontiguousarray(b)
        h = mix(_words64(b, g, 0) * MIX ^ mix(_words64(b, g, 8) + MIX))
        c = (h >> _POS << _POS) | np.arange(g, dtype=np.uint64)  # ties: leftmost
        m, s = c, 1
        while s * 2 <= SPAN:
            m = np.minimum(m[:-s], m[s:])
            s *= 2
        if s < SPAN:
            m = np.minimum(m[:len(m) - (SPAN - s)], m[SPAN - s:])
        ok = end[a:a + n] >= np.arange(a + LENGTH, a + n + LENGTH)
        p = (m[ok] & U64((1 << 30) - 1)).astype(np.int64)
        if len(p):
            p = p[np.concatenate(([True], p[1:] != p[:-1]))]
            pos.append(p + a)
            hashes.append(h[p])
    if not pos:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    p, h = np.concatenate(pos), np.concatenate(hashes)
    new = np.concatenate(([True], p[1:] != p[:-1]))  # a minimizer of two chunks
    return p[new], h[new]


def _batch(left: pa.Table, right: pa.Table):
    """Of the columns text, rank, digest, ...: (table, bytes, offsets, rank per row, is representative, other messages)."""
    t = left.combine_chunks()
    kind = right.column("kind").to_numpy()
    reps = right.filter(pa.array(kind == 0))
    known = set(zip(reps.column("rank").to_pylist(), reps.column("digest").to_pylist(), strict=True))
    rank = t.column(1).to_numpy()
    data, off = text_buffer(t.column(0))
    mine = np.array([(r, d) in known for r, d in zip(rank.tolist(), t.column(2).to_pylist(), strict=True)], bool)
    return t, data, off, rank, mine, right.filter(pa.array(kind != 0))


def _rep_text(data, off, mine):
    rows = np.flatnonzero(mine)
    d = np.concatenate([data[off[i]:off[i + 1]] for i in rows]) if len(rows) else np.zeros(0, np.uint8)
    return rows, d, np.concatenate(([0], np.cumsum(np.diff(off)[rows])))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string: their sizes, then their bytes."""
    raw = b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)
    head = np.array([len(arrays), len(raw), *(x.nbytes for x in arrays)], "<i8").tobytes()
    return head + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(b: bytes, *kinds) -> list[np.ndarray]:
    n, size = np.frombuffer(b, "<i8", 2)
    sizes = np.frombuffer(b, "<i8", int(n), 16)
    raw = pa.decompress(b[16 + 8 * int(n):], decompressed_size=int(size), codec="zstd", asbytes=True)
    at = np.concatenate(([0], np.cumsum(sizes)))
    return [np.frombuffer(raw, k, int(z) // np.dtype(k).itemsize, int(a)) for k, a, z in zip(kinds, at, sizes, strict=False)]


def _ranges(u: np.ndarray, bits: int) -> np.ndarray:
    """Where each hash range begins in sorted 64-bit hashes."""
    if not bits:
        return np.array([0, len(u)])
    return np.append(np.searchsorted(u, np.arange(1 << bits, dtype=np.uint64) << U64(64 - bits)), len(u))


def _known(h: np.ndarray, bits: int) -> np.ndarray:
    """A hash without the bits below the 32 that follow its range: what travels.
    With ranges in proportion to the input, the share of accidental equals
    (which only cost work) stays the same at every size."""
    cut = U64(max(0, 32 - bits))
    return h >> cut << cut


def _send(bits: int):
    """Packs the distinct minimizer hashes of a batch by hash range, 32 bits each."""
    def f(key, left, right):
        _, data, off, rank, mine, _ = _batch(left, right)
        rows, d, o = _rep_text(data, off, mine)
        p, h = anchors(d, o)
        h = _known(h, bits)
        doc = rank[rows][np.searchsorted(o, p, "right") - 1] if len(p) else np.zeros(0, np.int64)
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        new = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
        several = np.zeros(new.sum(), bool)
        group = np.cumsum(new) - 1
        several[group[1:][(h[1:] == h[:-1]) & (doc[1:] != doc[:-1])]] = True
        u = h[new]
        cut = _ranges(u, bits)
        full = np.flatnonzero(np.diff(cut))
        low = ((u << U64(bits)) >> U64(32)).astype("<u4")
        return pa.table({"range": pa.array(full, pa.int32()), "b": pa.array([key[0].as_py()] * len(full), pa.int32()),
                         "data": pa.array([low[cut[k]:cut[k + 1]].tobytes() for k in full], pa.binary()),
                         "flags": pa.array([np.packbits(several[cut[k]:cut[k + 1]]).tobytes() for k in full], pa.binary())})
    return f


def _meet(key, t):
    """For one hash range: which hashes of which batch other documents have too."""
    parts = [np.frombuffer(x, "<u4") for x in t.column("data").to_pylist()]
    again = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=len(x)).astype(bool) for x, f in zip(parts, t.column("flags").to_pylist(), strict=True)])
    h = np.concatenate(parts)
    order = np.argsort(h)
    s = h[order]
    same = s[1:] == s[:-1]
    hit = np.zeros(len(s), bool)
    hit[1:] |= same
    hit[:-1] |= same
    again[order] |= hit
    ends = np.cumsum([len(p) for p in parts])
    masks = [np.packbits(x).tobytes() for x in np.split(again, ends[:-1])]
    n = len(masks)
    return pa.table({"b": t.column("b"), "kind": pa.array([1] * n, pa.int32()), "rank": pa.nulls(n, pa.int64()), "digest": pa.nulls(n, pa.string()),
                     "range": t.column("range"), "data": pa.array(masks, pa.binary())})


MESSAGE = "b int, kind int, rank long, digest string, range int, data binary"
ROUTED = "route int, data binary"
WIDTH = LENGTH + LEFT
OCC = np.dtype([("rank", "<i8"), ("b", "<i4"), ("pos", "<i4")])
CUT = np.dtype([("rank", "<i8"), ("start", "<i4"), ("end", "<i4")])
EDGE = np.dtype([("key", "<u8"), ("rank", "<i8"), ("b", "<i4"), ("start", "<i4")])


def context(d: np.ndarray, o: np.ndarray, p: np.ndarray) -> np.ndarray:
    """For each position: its 50 bytes onward, the 34 before it backward (zero
    outside the text), and how many of both there are."""
    row = np.searchsorted(o, p, "right") - 1
    pad = np.concatenate((np.zeros(LEFT, np.uint8), d, np.zeros(LENGTH, np.uint8)))
    n_left, n_right = np.minimum(p - o[row], LEFT), np.minimum(o[row + 1] - p, LENGTH)
    out = np.empty((len(p), WIDTH + 2), np.uint8)
    j = np.concatenate((np.arange(LEFT, LEFT + LENGTH), np.arange(LEFT - 1, -1, -1)))
    for a in range(0, len(p), 50_000):
        z = slice(a, a + 50_000)
        c = pad[p[z, None] + j]
        c[:, :LENGTH][np.arange(LENGTH) >= n_right[z, None]] = 0
        c[:, LENGTH:][np.arange(LEFT) >= n_left[z, None]] = 0
        out[z, :WIDTH] = c
    out[:, WIDTH], out[:, WIDTH + 1] = n_right, n_left
    return out


def _keys(c: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(c[:, :WIDTH]).view(f"S{WIDTH}").ravel()


def _contexts(bits: int, splitters):
    """Suffixes of a batch at minimizers that other documents have too, packed by bucket."""
    def f(key, left, right):
        b = key[0].as_py()
        _, data, off, rank, mine, more = _batch(left, right)
        rows, d, o = _rep_text(data, off, mine)
        p, h = anchors(d, o)
        h = _known(h, bits)
        u = np.unique(h)
        cut = _ranges(u, bits)
        again = np.zeros(len(u), bool)
        for k, x in zip(more.column("range").to_pylist(), more.column("data").to_pylist(), strict=True):
            again[cut[k]:cut[k + 1]] = np.unpackbits(np.frombuffer(x, np.uint8), count=int(cut[k + 1] - cut[k])).astype(bool)
        p = p[again[np.searchsorted(u, h)]] if len(u) else p
        c = context(d, o, p)
        row = np.searchsorted(o, p, "right") - 1
        occ = np.empty(len(p), OCC)
        occ["rank"], occ["b"], occ["pos"] = rank[rows][row] if len(p) else 0, b, p - o[row]
        keys = _keys(c)
        order = np.argsort(keys, kind="stable")
        c, occ, keys = c[order], occ[order], keys[order]
        at = np.concatenate(([0], np.searchsorted(keys, splitters.value), [len(keys)]))
        new = np.concatenate(([True], (c[1:] != c[:-1]).any(1))) if len(c) else np.zeros(0, bool)
        out = ([], [])
        for k in np.flatnonzero(np.diff(at)):
            x, y = at[k], at[k + 1]
            first = np.flatnonzero(new[x:y])
            if not len(first) or first[0]:
                first = np.append(0, first)  # equal bytes, other lengths: a bucket may begin inside a run
            out[0].append(int(k))
            out[1].append(pack(c[x:y][first], np.diff(np.append(first, y - x)).astype("<u4"), occ[x:y]))
        return pa.table({"bucket": pa.array(out[0], pa.int32()), "data": pa.array(out[1], pa.binary())})
    return f


def _sampled_contexts(batches):
    """Every eighth minimizer of the sampled texts."""
    for b in batches:
        data, off = text_buffer(b.column(0))
        p, _ = anchors(data, off)
        c = context(data, off, p[::8])
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in c[:, :WIDTH]], pa.binary())], ["c"])


def multikey_sort(chars: np.ndarray) -> np.ndarray:
    """Order of the rows of a matrix of characters: each pass sorts, by the
    next character, the groups that are equal so far and have several rows."""
    n, depth = chars.shape
    order = np.argsort(chars[:, 0], kind="stable") if depth else np.arange(n)
    new = np.ones(n, bool)
    if n:
        k = chars[order, 0]
        new[1:] = k[1:] != k[:-1]
    for d in range(1, depth):
        alone = new & np.append(new[1:], True)
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        group = np.cumsum(new)[at]
        k = chars[order[at], d]
        sub = np.lexsort((k, group))
        order[at] = order[at][sub]
        g, k = group[sub], k[sub]
        fresh = np.concatenate(([True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])))
        new[at] |= fresh
    return order


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of every run of equal values."""
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)
    return first, np.append(first[1:], len(x))[:len(first)]


def _by_batch(b: np.ndarray, rank: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Spans packed by batch: (batches, packed spans)."""
    cuts = np.empty(len(start), CUT)
    cuts["rank"], cuts["start"], cuts["end"] = rank, start, end
    order = np.lexsort((cuts["start"], cuts["rank"], b))
    b, cuts = b[order], cuts[order]
    first, ends = _runs(b)
    return b[first], [pack(cuts[x:y]) for x, y in zip(first, ends, strict=True)]


def _bucket(slots: int):
    """Sorts one bucket of suffixes and settles its windows: spans, routed by
    batch; the windows of its first and last gram, routed by slot (-1 - slot),
    meet those of other buckets."""
    def f(key, t):
        got = [unpack(x, np.uint8, "<u4", OCC) for x in t.column("data").to_pylist()]
        c = np.concatenate([x[0].reshape(-1, WIDTH + 2) for x in got])
        n_occ = np.concatenate([x[1] for x in got]).astype(np.int64)
        occ = np.concatenate([x[2] for x in got])
        del got
        chars = np.concatenate((c[:, :WIDTH], np.zeros((len(c), -WIDTH % 8), np.uint8)), 1).view(">u8").astype(np.uint64)
        order = multikey_sort(chars)
        del chars
        at = (np.cumsum(n_occ) - n_occ)[order]
        c, n_occ = c[order], n_occ[order]
        occ = occ[np.repeat(at - (np.cumsum(n_occ) - n_occ), n_occ) + np.arange(n_occ.sum())]
        first_occ = np.cumsum(n_occ) - n_occ
        n, n_right, n_left = len(c), c[:, WIDTH].astype(np.int64), c[:, WIDTH + 1].astype(np.int64)
        low = np.minimum.reduceat(occ["rank"], first_occ)
        gram = np.ascontiguousarray(c[:, :GRAM]).view("<u8")
        group = np.cumsum(np.concatenate(([True], (gram[1:] != gram[:-1]).any(1)))) - 1
        # prefix hashes of the 84 bytes around every suffix
        pre = np.zeros((n, WIDTH + 1), np.uint64)
        for a in range(0, n, 50_000):
            z = slice(a, a + 50_000)
            whole = np.concatenate((c[z, WIDTH - 1:LENGTH - 1:-1], c[z, :LENGTH]), 1).astype(np.uint64) + U64(1)
            np.cumsum(whole * _POW[:WIDTH], axis=1, out=pre[z, 1:])
        least = np.full((n, SPAN), np.iinfo(np.int64).max)
        edge = (group == 0) | (group == group[-1])
        salt = mix(group.astype(np.uint64) + U64(1))
        offset, edge_row = [], []
        for o in range(SPAN):
            ok = np.flatnonzero((n_left >= o) & (n_right >= LENGTH - o))
            if not len(ok):
                continue
            # the gram's number makes the key exact but for suffixes of one gram
            k = mix((pre[ok, LEFT - o + LENGTH] - pre[ok, LEFT - o]) * _INV[LEFT - o]) ^ salt[ok]
            s = np.argsort(k)
            first, ends = _runs(k[s])
            least[ok[s], o] = np.repeat(np.minimum.reduceat(low[ok][s], first), ends - first)
            e = ok[edge[ok]]
            e = e[low[e] == least[e, o]]
            offset.append(np.full(len(e), o))
            edge_row.append(e)
        parts = []
        owner = np.repeat(np.arange(n), n_occ)
        for a in range(0, len(occ), 100_000):
            part, row = occ[a:a + 100_000], owner[a:a + 100_000]
            cov = np.zeros((len(part), SPAN + 2), np.int8)
            cov[:, 1:-1] = least[row] < part["rank"][:, None]
            d = np.diff(cov, axis=1)
            r, o1 = np.nonzero(d == 1)
            _, o2 = np.nonzero(d == -1)  # the offsets o1..o2-1 of one occurrence
            p = part["pos"][r].astype(np.int64)
            parts.append((part["b"][r], part["rank"][r], p - (o2 - 1), p - o1 + LENGTH))
        route, packed = _by_batch(*(np.concatenate([x[q] for x in parts]) for q in range(4)))
        # smallest occurrences of the windows of the first and last gram
        o, e = np.concatenate([*offset, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*edge_row, np.zeros(0, np.int64)]).astype(np.int64)
        m = n_occ[e]
        pick = np.repeat(first_occ[e] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        o, e = np.repeat(o, m), np.repeat(e, m)
        small = occ["rank"][pick] == low[e]
        pick, o, e = pick[small], o[small], e[small]
        w = mix((pre[e, LEFT - o + LENGTH] - pre[e, LEFT - o]) * _INV[LEFT - o]) ^ mix(gram[e, 0] * MIX + gram[e, 1] + o.astype(np.uint64))
        entry = np.empty(len(pick), EDGE)
        entry["key"], entry["rank"], entry["b"], entry["start"] = w, occ["rank"][pick], occ["b"][pick], occ["pos"][pick] - o
        slot = ((w >> U64(33)) % U64(slots)).astype(np.int64)
        s = np.argsort(slot, kind="stable")
        slot, entry = slot[s], entry[s]
        first, ends = _runs(slot)
        return pa.table({"route": pa.array(np.concatenate((route, -1 - slot[first])), pa.int32()),
                         "data": pa.array(packed + [pack(entry[x:y]) for x, y in zip(first, ends, strict=True)], pa.binary())})
    return f


def _route(key, t):
    """Unites the spans of one batch, or settles the windows of one slot."""
    at = key[0].as_py()
    if at < 0:
        e = np.concatenate([unpack(x, EDGE)[0] for x in t.column("data").to_pylist()])
        e = e[np.argsort(e["key"], kind="stable")]
        first, ends = _runs(e["key"])
        e = e[e["rank"] > np.repeat(np.minimum.reduceat(e["rank"], first), ends - first)]
        b, data = _by_batch(e["b"], e["rank"], e["start"], e["start"] + LENGTH)
    else:
        cuts = np.concatenate([unpack(x, CUT)[0] for x in t.column("data").to_pylist()])
        cuts = cuts[np.lexsort((cuts["start"], cuts["rank"]))]
        first, ends = _runs(cuts["rank"])
        runs = [_union(cuts["start"][x:y], cuts["end"][x:y]) for x, y in zip(first, ends, strict=True)]
        rank = np.repeat(cuts["rank"][first], [len(s) for s, _ in runs])
        b, data = _by_batch(np.full(len(rank), at), rank, np.concatenate([s for s, _ in runs]), np.concatenate([e for _, e in runs]))
    n = len(data)
    return pa.table({"b": pa.array(b, pa.int32()), "kind": pa.array([2] * n, pa.int32()), "rank": pa.nulls(n, pa.int64()), "digest": pa.nulls(n, pa.string()),
                     "range": pa.nulls(n, pa.int32()), "data": pa.array(data, pa.binary())})


def _union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans."""
    order = np.argsort(start, kind="stable")
    s, top = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], s[1:] > top[:-1]))
    return s[new], top[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)]


def _cut(keep: list[str], names: list[str], whole_chars: bool):
    def f(key, left, right):
        t, data, off, rank, mine, more = _batch(left, right)
        parts = [unpack(x, CUT)[0] for x in more.column("data").to_pylist()]
        cuts = np.concatenate(parts) if parts else np.zeros(0, CUT)
        cuts = cuts[np.argsort(cuts["rank"], kind="stable")]
        a, z = np.searchsorted(cuts["rank"], rank), np.searchsorted(cuts["rank"], rank, "right")
        size, removed, spans, kept = np.diff(off), [], [], []
        for i in range(len(rank)):
            n, b = int(size[i]), data[off[i]:off[i + 1]]
            if not mine[i]:
                s, e = (np.zeros(1, int), np.array([n])) if n >= LENGTH else (np.zeros(0, int), np.zeros(0, int))
            elif z[i] > a[i]:
                s, e = _union(cuts["start"][a[i]:z[i]], cuts["end"][a[i]:z[i]])
            else:
                s = e = np.zeros(0, int)
            if whole_chars and len(s):
                head = np.append((b & 0xC0) != 0x80, True)
                nxt = np.minimum.accumulate(np.where(head, np.arange(n + 1), n)[::-1])[::-1]
                prv = np.maximum.accumulate(np.where(head, np.arange(n + 1), 0))
                s, e = nxt[s], prv[e]
                s, e = s[e > s], e[e > s]
            on = np.zeros(n + 1, np.int8)
            on[s] += 1
            on[e] -= 1
            kept.append(b[np.cumsum(on[:-1]) == 0].tobytes() if len(s) else b.tobytes())
            removed.append(int((e - s).sum()))
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e, strict=True)])
        st = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        new = [pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, st), pa.array(kept, pa.binary())]
        return pa.table([t.column(k) for k in range(3, 3 + len(keep))] + new, names=[*keep, *names])
    return f


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                   whole_chars: bool = False) -> DataFrame:
    """The ``keep`` columns (default: all) plus n_bytes, n_removed, spans (maximal
    removed runs, in bytes) and kept (the remaining bytes).  With
    ``whole_chars`` a run keeps characters that it covers only in part."""
    spark = docs.sparkSession
    keep = list(docs.columns if keep is None else keep)
    top = 2**63 - 1
    total, n_docs = docs.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    total = total or 0
    n_batches = max(1, -(-total // BATCH_BYTES))
    bits = max(0, (-(-total // RANGE_BYTES) - 1).bit_length())
    buckets = max(1, -(-total // BUCKET_BYTES))
    own = []
    for c in ("_text", "_rank", "_digest", "_b"):
        own.append(free_name([*keep, *own], c))
    body, order, digest, batch = own
    base = docs.select(*(F.col(f"`{c}`") for c in keep), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(body),
                       F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(top)).alias(order))
    # by id and text, so that many rows of one id, or of none, do not meet in one batch
    place = lambda c, t: F.pmod(F.xxhash64(c, t), F.lit(n_batches)).cast("int")
    d = base.select(body, order, F.sha2(F.col(body), 256).alias(digest), *(F.col(f"`{c}`") for c in keep)).withColumn(batch, place(order, digest))
    ids = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(top)).alias("rank"), F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256).alias("digest"))
    reps = ids.groupBy("digest").agg(F.min("rank").alias("rank")).select(
        place("rank", "digest").alias("b"), F.lit(0).alias("kind"), "rank", "digest", F.lit(None).cast("int").alias("range"), F.lit(None).cast("binary").alias("data"))
    by_batch = lambda extra: d.groupBy(batch).cogroup((reps.unionByName(extra) if extra is not None else reps).groupBy("b"))
    share = min(1.0, max(SAMPLE_BYTES * buckets / max(total, 1), 64 / max(n_docs, 1)))
    sample = base.where(F.abs(F.xxhash64(order, F.lit(3))) <= int(share * (2.0**63 - 1024))).select(body)
    found = sample.mapInArrow(_sampled_contexts, "c binary").toArrow().column("c").to_pylist() if buckets > 1 else []
    found = np.sort(np.array(found, f"S{WIDTH}"))
    splitters = spark.sparkContext.broadcast(found[np.arange(1, buckets) * len(found) // buckets] if len(found) else found)
    hashes = by_batch(None).applyInArrow(lean_group(_send(bits)), "range int, b int, data binary, flags binary")
    masks = hashes.groupBy("range").applyInArrow(lean_group(_meet), MESSAGE)
    suffixes = by_batch(masks).applyInArrow(lean_group(_contexts(bits, splitters)), "bucket int, data binary")
    settled = suffixes.groupBy("bucket").applyInArrow(lean_group(_bucket(buckets)), ROUTED)
    spans = settled.groupBy("route").applyInArrow(lean_group(_route), MESSAGE)
    names = []
    for x in ("n_bytes", "n_removed", "spans", "kept"):
        names.append(free_name([*keep, *names], x))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType()),
                           T.StructField(names[2], T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField(names[3], T.BinaryType())])
    return by_batch(spans).applyInArrow(lean_group(_cut(keep, names, whole_chars)), schema)


def op7(spark, sf_dir: str) -> DataFrame:
    r = remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return r.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS rank, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, rank, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT rid, rank, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
first AS (SELECT s, min(rank) AS least FROM w GROUP BY s),
hit AS (SELECT rid, i FROM w JOIN first USING (s) WHERE least < rank),
marked AS (SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
numbered AS (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS run FROM marked),
runs AS (SELECT rid, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY rid, run),
gaps AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM runs),
cut AS (
  SELECT rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS tail,
         string_agg(substr(h, (2 * before + 1)::BIGINT, (2 * (a - before))::BIGINT), '' ORDER BY a) AS kept
  FROM gaps JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE kept || substr(h, (2 * tail + 1)::BIGINT) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (rid)
"""
