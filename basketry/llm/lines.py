r"""Line dedup (operator 11): per-document bitmaps of the lines to keep.

Texts are split at ``\n``.  A line's key is the line without ``[\x20\x09-\x0D]``
at both ends, A-Z lower-cased.  A key of at least ``MIN_CHARS`` code points that
stands in at least ``MIN_DOCS`` documents is a repeat: all its lines go, except
those in the largest document id that holds it.

How it runs:

1. A narrow map writes, for each document, the 128-bit hashes and positions of
   its long enough lines (checkpointed once: small beside the text).
2. These are range-partitioned by (hash, document descending, position) and
   sorted so inside each partition.  A hash of very many lines spans several
   partitions, so no key meets in one task.
3. Each partition is streamed once.  The first document of a hash is the one
   that keeps its lines; the second one's lines wait until a third document
   shows up; later ones go at once.  Only the first hash of a partition (it may
   have begun in an earlier one) and the second document of its last hash stay
   undecided; the three largest documents of these two hashes, six rows at most
   for each partition, settle them in a broadcast join.
4. Dropped positions are grouped by document and returned as a compressed bitmap
   of the lines to keep (:func:`unpack_bitmap`); text moves only where
   :func:`kept_texts` applies the bitmaps to it.

Memory: a task holds one Arrow batch, one document's waiting positions, or one
document's bits.

Defined results: a null or empty text is one empty line; rows that share doc_id
are one document, and get one bitmap for each different text; all rows of null
doc_id are one document with the smallest id (-2**63); a key that repeats inside
one document only is no repeat; repeated rows get the same bitmap; an empty
table gives no rows; further columns of ``docs`` are not looked at, whatever
their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import SLICE_BYTES, sha_hex, table, text_slices
from basketry.session import checkpoint_root

MIN_CHARS = 20
MIN_DOCS = 3
SPACE = b" \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)

DROP, OPEN, LARGEST = 0, 1, 2
FIELDS = ("hi", "lo", "doc", "row", "at")
INDEX = "doc long, row long, n_lines long, lines array<struct<hi:long,lo:long,at:long>>"


# ---------------------------------------------------------------------- lines

def key_of(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, None if it is too short to count."""
    key = line.strip(SPACE).lower()  # of bytes: ASCII letters only
    n = len(key)
    if n < min_chars or n < 4 * min_chars and not key.isascii() and sum(b & 0xC0 != 0x80 for b in key) < min_chars:
        return None
    return key


def text_lines(data: memoryview | bytes, newlines: np.ndarray):
    """(number, line) of one text, given the positions of its line feeds."""
    start = 0
    for k, end in enumerate(newlines.tolist()):
        yield k, bytes(data[start:end])
        start = end + 1
    yield len(newlines), bytes(data[start:])


def _index(min_chars: int):
    def run(batches):
        for b in batches:
            doc, row = b.column(0), b.column(1)
            for i, j, data, off in text_slices(b.column(2)):
                feeds = np.flatnonzero(data == 10)
                cut = np.searchsorted(feeds, off)
                view, ends, at, digest = memoryview(data), [0], [], []
                for r in range(j - i):
                    for k, line in text_lines(view[off[r]:off[r + 1]], feeds[cut[r]:cut[r + 1]] - off[r]):
                        key = key_of(line, min_chars)
                        if key is not None:
                            at.append(k)
                            digest.append(hashlib.blake2b(key, digest_size=16).digest())
                    ends.append(len(at))
                h = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
                lines = pa.StructArray.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(np.array(at, np.int64))], ["hi", "lo", "at"])
                yield pa.RecordBatch.from_arrays([doc.slice(i, j - i), row.slice(i, j - i), pa.array(np.diff(cut) + 1, pa.int64()), pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), lines)], ["doc", "row", "n_lines", "lines"])
    return run


# --------------------------------------------------------------------- stream

class Stream:
    """Verdicts on the sorted lines of one partition, batch by batch."""

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.last = None      # (hi, lo, doc) of the line before
        self.ordinal = 0      # of its document in its hash
        self.first_hash = True
        self.waiting: list[list[np.ndarray]] = []
        self.largest: list[int] = []   # of the current hash

    def _rows(self, kind: int, cols) -> pa.RecordBatch:
        n = len(cols[0])
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *(pa.array(c) for c in cols)], ["kind", *FIELDS])

    def _summary(self) -> pa.RecordBatch:
        hi, lo, _ = self.last
        n = len(self.largest)
        one = lambda x: np.full(n, x, np.int64)
        return self._rows(LARGEST, [one(hi), one(lo), np.array(self.largest, np.int64), one(0), one(0)])

    def batch(self, cols: list[np.ndarray]):
        hi, lo, doc = cols[:3]
        n = len(hi)
        if not n:
            return
        new = np.ones(n, bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        other = np.ones(n, bool)
        other[1:] = doc[1:] != doc[:-1]
        if self.last is not None:
            new[0] = (int(hi[0]), int(lo[0])) != self.last[:2]
            other[0] = int(doc[0]) != self.last[2]
        fresh = new | other
        count = np.cumsum(fresh)
        start = np.flatnonzero(new)                  # of the hashes that begin here
        seg = np.cumsum(new)                         # 0: the hash of the batch before
        base = np.concatenate(([-self.ordinal], count[start]))
        ordinal = count - base[seg]
        ends = np.concatenate((start, [n])) - 1      # last line of segment 0, 1, ...
        most = np.where(ends >= 0, ordinal[ends], self.ordinal)
        last_seg = len(start)
        if last_seg and self.last is not None:       # the hash before is over
            if self.first_hash:
                if ends[0] >= 0:
                    self._note(doc[:ends[0] + 1], fresh[:ends[0] + 1])
                yield self._summary()
            elif most[0] >= self.min_docs - 1:
                for w in self.waiting:
                    yield self._rows(DROP, w)
            self.waiting = []
        # undecided: every line of the partition's first hash
        in_first = seg == (1 if self.last is None else 0) if self.first_hash else np.zeros(n, bool)
        enough = most[seg] >= self.min_docs - 1
        drop = ~in_first & (ordinal >= 1) & enough
        for kind, mask in ((DROP, drop), (OPEN, in_first)):
            if mask.any():
                yield self._rows(kind, [c[mask] for c in cols])
        if not last_seg:                             # one hash fills the batch
            self._note(doc, fresh)
            if not self.first_hash and most[0] >= self.min_docs - 1:
                for w in self.waiting:
                    yield self._rows(DROP, w)
                self.waiting = []
            z = slice(0, n)
        else:
            if self.first_hash and self.last is None and last_seg > 1:
                self.last = (int(hi[0]), int(lo[0]), 0)
                self.largest = []
                self._note(doc[:start[1]], fresh[:start[1]])
                yield self._summary()
            self.first_hash = self.first_hash and self.last is None and last_seg == 1
            self.largest = []
            z = slice(start[-1], n)
            self._note(doc[z], fresh[z])
        if not self.first_hash and most[-1] < self.min_docs - 1:
            wait = ordinal[z] >= 1
            if wait.any():
                self.waiting.append([c[z][wait] for c in cols])
        self.last = (int(hi[-1]), int(lo[-1]), int(doc[-1]))
        self.ordinal = int(ordinal[-1])

    def _note(self, doc: np.ndarray, fresh: np.ndarray) -> None:
        """The largest documents of the current hash, as many as decide it."""
        room = self.min_docs - len(self.largest)
        if room > 0:
            self.largest += doc[np.flatnonzero(fresh)[:room]].tolist()

    def end(self):
        if self.last is None:
            return
        yield self._summary()
        for w in self.waiting:
            yield self._rows(OPEN, w)


def _stream(min_docs: int):
    def run(batches):
        s = Stream(min_docs)
        for b in batches:
            yield from s.batch([b.column(k).to_numpy(zero_copy_only=False) for k in range(len(FIELDS))])
        yield from s.end()
    return run


# -------------------------------------------------------------------- bitmaps

def pack_bitmap(n_lines: int, dropped: np.ndarray) -> bytes:
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1)


def unpack_bitmap(data: bytes, n_lines: int) -> np.ndarray:
    """One boolean for each line: whether it is kept."""
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8), count=n_lines, bitorder="little").astype(bool)


def _bitmaps(batches):
    for b in batches:
        n = b.column(2).to_numpy()
        lists = b.column(3)
        off = lists.offsets.to_numpy()
        at = lists.values.to_numpy(zero_copy_only=False)
        keep = [pack_bitmap(int(n[i]), at[off[i]:off[i + 1]]) for i in range(len(n))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(np.diff(off), pa.int64()), pa.array(keep, pa.binary())], ["doc", "row", "n_lines", "n_dropped", "keep"])


def _keys(docs: DataFrame, text: str, id_col: str, *more) -> DataFrame:
    t = F.col(f"`{text}`").cast("string")
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(F.coalesce(t, F.lit(""))).alias("row"), t.alias("text"), *more)


def keep_bitmaps(docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, row, n_lines, n_dropped, keep): one row for each document id and
    different text; ``row`` is the text's xxhash64, ``keep`` the bitmap."""
    if min_docs < 2:
        raise ValueError("a repeat stands in two documents at least")
    spark = docs.sparkSession
    checkpoint_root(spark)
    index = _keys(docs, text, id_col).mapInArrow(_index(min_chars), INDEX).checkpoint()
    lines = index.select("doc", "row", F.inline("lines")).select(*FIELDS)
    order = ["hi", "lo", F.col("doc").desc(), "row", "at"]
    said = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    said = said.mapInArrow(_stream(min_docs), "kind int, hi long, lo long, doc long, row long, at long").checkpoint()
    # at most 2 * min_docs rows for each partition of the stream
    largest = said.where(F.col("kind") == LARGEST).groupBy("hi", "lo").agg(F.collect_set("doc").alias("docs"))
    largest = largest.where(F.size("docs") >= min_docs).select("hi", "lo", F.array_max("docs").alias("last"))
    settled = said.where(F.col("kind") == OPEN).join(F.broadcast(largest), ["hi", "lo"]).where(F.col("doc") != F.col("last"))
    gone = said.where(F.col("kind") == DROP).select("doc", "row", "at").unionByName(settled.select("doc", "row", "at"))
    gone = gone.groupBy("doc", "row").agg(F.collect_set("at").alias("at"))
    head = index.groupBy("doc", "row").agg(F.max("n_lines").alias("n_lines"))
    every = head.join(gone, ["doc", "row"], "left").select("doc", "row", "n_lines", F.coalesce("at", F.array().cast("array<long>")).alias("at"))
    return every.mapInArrow(_bitmaps, "doc long, row long, n_lines long, n_dropped long, keep binary")


def keep_lines(text: bytes, keep: np.ndarray) -> bytes:
    if keep.all():
        return text
    feeds = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    start, end = np.concatenate(([0], feeds + 1)), np.concatenate((feeds, [len(text)]))
    return b"\n".join(text[start[k]:end[k]] for k in np.flatnonzero(keep).tolist())


def _apply(digest: bool):
    def run(batches):
        for b in batches:
            head, (texts, n_lines, n_dropped, keep) = b.columns[:-4], b.columns[-4:]
            done = 0
            while done < len(texts):  # some rows at a time, or one long one
                out, size, first = [], 0, done
                while done < len(texts) and (size < SLICE_BYTES or done == first):
                    t = (texts[done].as_py() or "").encode()
                    size += len(t)
                    if n_dropped[done].as_py():
                        t = keep_lines(t, unpack_bitmap(keep[done].as_py(), n_lines[done].as_py()))
                    out.append(sha_hex(t) if digest else t.decode())
                    done += 1
                z = lambda c: c.slice(first, done - first)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([*(z(c) for c in head), z(n_lines), z(n_dropped), pa.array(out, pa.string())], [*(f"c{i}" for i in range(len(head))), "n_lines", "n_dropped", "kept"])
    return run


def kept_texts(docs: DataFrame, bitmaps: DataFrame, text: str = "text", id_col: str = "doc_id", digest: bool = False) -> DataFrame:
    """(id, n_lines, n_dropped, kept): the text without its dropped lines, or
    its sha256; one row for each row of ``docs``.  Matched by id and text hash,
    so rows that share an id, or have none, are spread over the tasks."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = _keys(docs, text, id_col, F.col(f"`{id_col}`").alias("c0"))
    both = src.join(bitmaps, ["doc", "row"]).select("c0", "text", "n_lines", "n_dropped", "keep")
    out = both.mapInArrow(_apply(digest), f"c0 {kind}, n_lines long, n_dropped long, kept string")
    return out.withColumnRenamed("c0", id_col)


def op11(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return kept_texts(docs, keep_bitmaps(docs), digest=True).withColumnRenamed("kept", "kept_sha256")


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
often AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key
  HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3),
v AS (SELECT k.*, often.key IS NOT NULL AND k.doc_id IS DISTINCT FROM often.last AS gone FROM k LEFT JOIN often ON k.key = often.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM v GROUP BY rid
"""
