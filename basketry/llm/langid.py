"""Language identification (operator 1): one interpolated Kneser-Ney character
model per language, stored in sorted hash arrays.

Texts are lower-cased; every run of non-letters is one blank; each row is
preceded by start symbols.  Training counts the 5-grams of a bounded sample of
labelled rows with Spark; all lower orders follow from the distinct grams
(Kneser-Ney continuation counts).  For each order one sorted array holds the
hashes of all grams seen in any language, beside a matrix of their
interpolated log probabilities per language, so one lookup serves every
language; a second sorted array holds the back-off weights of the contexts.

A row gets the language of the lowest cross-entropy per symbol.  A held-back
part of the sample calibrates the temperature of ``score`` and the rejection
bound: a row is rejected if its cross-entropy exceeds, by more than nearly all
calibration rows of its language did (``QUANTILE``; rows that another language's
model fits better left out, so wrong labels do not loosen it) and by ``SLACK``, what
its language and length let expect.

Defined results: null text or text without a letter gives ``und``, score 0,
rejected; equal cross-entropies go to the smaller language code; without any
training row everything is ``und``; repeated rows each get a result; a text longer
than ``CHUNK`` is read in parts that end at blanks, each going on from the symbols
before it, so its length does not add to the memory of a task.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import MIX, U64, crc_mod, lean, map_text, mix, slices, table, text_buffer, text_parts

ORDER = 5
#: Expected characters of training text per language: the bound of the fit.
TRAIN_CHARS = 1_000_000
#: Expected rows that calibrate score and rejection.
CALIBRATION_ROWS = 3_000
#: Slack in nats added to the rejection bound.
SLACK = 1.5
#: Share of a language's calibration rows that set its bound; the rest may be mislabelled.
QUANTILE = 0.97
#: Standard errors that a text of a given length may lie above the bound.
SIGMAS = 6.0
START, BLANK = 1, 32
CONST = [mix(np.array([i + 1], np.uint64) * MIX)[0] | U64(1) for i in range(ORDER)]
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def symbols(texts: list[str], lead: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(padded symbols, positions of real symbols, their rows, rows with a letter);
    ``lead``: the symbols before the first text, which goes on from there."""
    low = [t.lower() for t in texts]
    cp = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(low)), [len(t) for t in low])
    is_letter = letters()[cp]
    new = np.concatenate(([True], row[1:] != row[:-1])) if len(cp) else np.zeros(0, bool)
    before = np.concatenate(([False], is_letter[:-1])) & ~new
    keep = is_letter | before  # a blank only after a letter
    sym, row = np.where(is_letter, cp, np.uint32(BLANK))[keep], row[keep]
    at = np.arange(len(sym)) + (row + 1) * (ORDER - 1)
    padded = np.full(len(sym) + len(low) * (ORDER - 1), START, np.uint32)
    padded[at] = sym
    if lead is not None:
        padded[:ORDER - 1] = lead
    has = np.zeros(len(low), bool)
    has[row] = True
    return padded, at, row, has


def gram_hash(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of grams given as symbol arrays, last symbol first."""
    h = np.full(len(parts[0]), len(parts), np.uint64) * MIX
    for j, p in enumerate(parts):
        h += p * CONST[j]
    return mix(h)


class HashArray:
    """A sorted array of hashes with a directory over their leading bits."""

    def __init__(self, h: np.ndarray):
        self.h = np.concatenate((h, np.full(1, np.iinfo(np.uint64).max, np.uint64)))
        bits = max(8, int(len(h)).bit_length() + 1)
        self.shift = U64(64 - bits)
        self.dir = np.searchsorted(h, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, q: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 where absent."""
        at = self.dir[q >> self.shift]
        v = self.h[at]
        out = np.where(v == q, at, -1)
        todo = np.flatnonzero(v < q)
        at = at[todo] + 1
        while len(todo):
            v, w = self.h[at], q[todo]
            eq = v == w
            out[todo[eq]] = at[eq]
            on = v < w
            todo, at = todo[on], at[on] + 1
        return out


class Model:
    """Kneser-Ney models of all languages over shared sorted hash arrays.

    ``counts[l]`` is (grams, n): symbols [m, ORDER] uint32 and their counts."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.langs, L = langs, len(langs)
        self.temperature, self.spread, self.bound = 10.0, np.ones(L), np.full(L, np.inf)
        every = np.concatenate([g for g, _ in counts]) if counts else np.zeros((0, ORDER), np.uint32)
        self.uniform = -np.log(len(np.unique(every)) + 1.0)
        self.grams, self.contexts, self.logp, self.logb = [], [], [], []
        sym = [mix((g.astype(np.uint64) + U64(1)) * MIX) for g, _ in counts]  # per language [m, ORDER]
        types = [(s, n.astype(np.float64)) for s, (_, n) in zip(sym, counts, strict=True)]
        per_order = {}
        for n in range(ORDER, 0, -1):
            per_order[n] = [self._order(s[:, ORDER - n:], c, n) for s, c in types]
            nxt = []
            for s, _ in types:  # continuation counts: distinct longer grams by suffix
                short = s[:, s.shape[1] - n + 1:] if n > 1 else s[:, :0]
                if n > 1:
                    h = gram_hash([short[:, k] for k in range(n - 2, -1, -1)])
                    _, first, many = np.unique(h, return_index=True, return_counts=True)
                    nxt.append((np.pad(short[first], ((0, 0), (ORDER - n + 1, 0))), many.astype(np.float64)))
            if n > 1:
                types = nxt
        lower_h, lower_p = None, None
        for n in range(1, ORDER + 1):
            h = np.unique(np.concatenate([o["h"] for o in per_order[n]])) if L else np.zeros(0, np.uint64)
            ch = np.unique(np.concatenate([o["ch"] for o in per_order[n]])) if L else np.zeros(0, np.uint64)
            p, back = np.zeros((L, len(h))), np.ones((L, len(ch)))
            ctx, suf = np.zeros(len(h), np.int64), np.zeros(len(h), np.uint64)
            for o in per_order[n]:
                i = np.searchsorted(h, o["h"])
                ctx[i], suf[i] = np.searchsorted(ch, o["hc"]), o["hs"]
            for k, o in enumerate(per_order[n]):
                p[k, np.searchsorted(h, o["h"])] = o["disc"]
                back[k, np.searchsorted(ch, o["ch"])] = o["gamma"]
            low = np.exp(self.uniform) if n == 1 else lower_p[:, np.searchsorted(lower_h, suf)]
            p += back[:, ctx] * low
            lower_h, lower_p = h, p
            self.grams.append(HashArray(h))
            self.contexts.append(HashArray(ch))
            self.logp.append(np.log(np.maximum(p, 1e-300)).astype(np.float32))
            self.logb.append(np.log(np.maximum(back, 1e-300)).astype(np.float32))

    @staticmethod
    def _order(s: np.ndarray, c: np.ndarray, n: int) -> dict:
        """Discounted probabilities and back-off weights of one language's grams of order n."""
        col = [s[:, k] for k in range(n - 1, -1, -1)]
        h, ch = gram_hash(col), gram_hash(col[1:]) if n > 1 else np.zeros(len(s), np.uint64)
        o = np.argsort(h)
        h, ch, c = h[o], ch[o], c[o]
        hs = gram_hash(col[:-1])[o] if n > 1 else np.zeros(len(s), np.uint64)
        n1, n2 = np.sum(c == 1), np.sum(c == 2)
        d = min(0.95, max(0.1, n1 / max(n1 + 2 * n2, 1)))
        uc, inv = np.unique(ch, return_inverse=True)
        total, kinds = np.bincount(inv, c, len(uc)), np.bincount(inv, minlength=len(uc))
        return {"h": h, "hc": ch, "hs": hs, "ch": uc, "disc": np.maximum(c - d, 0) / total[inv], "gamma": d * kinds / total}

    def cross_entropy(self, texts: list[str], lead: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nats per symbol [rows, languages], symbols per row, rows with a letter)."""
        padded, at, row, has = symbols(texts, lead)
        L, m = len(self.langs), len(texts)
        n_sym = np.bincount(row, minlength=m)
        out = np.zeros((m, L))
        if not len(at) or not L:
            return out, n_sym, has
        v = mix((padded.astype(np.uint64) + U64(1)) * MIX)
        firsts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        total = np.zeros((L, len(at)), np.float32)
        todo, n = np.arange(len(at)), ORDER
        while len(todo) and n:
            i = at[todo]
            col = [v[i - j] for j in range(n)]
            k = self.grams[n - 1].find(gram_hash(col))
            hit = k >= 0
            for lang in range(L):
                total[lang, todo[hit]] += self.logp[n - 1][lang, k[hit]]
            todo = todo[~hit]
            if len(todo):
                c = self.contexts[n - 1].find(gram_hash([x[~hit] for x in col[1:]]) if n > 1 else np.zeros(len(todo), np.uint64))
                on = c >= 0
                for lang in range(L):
                    total[lang, todo[on]] += self.logb[n - 1][lang, c[on]]
            n -= 1
        if len(todo):
            total[:, todo] += np.float32(self.uniform)
        for lang in range(L):
            out[row[firsts], lang] = -np.add.reduceat(total[lang].astype(np.float64), firsts)
        return out / np.maximum(n_sym, 1)[:, None], n_sym, has

    def calibrate(self, ce: np.ndarray, n: np.ndarray, truth: np.ndarray) -> None:
        """Temperature by likelihood; per language the spread of cross-entropy by
        length and a rejection bound that no calibration row exceeds."""
        if not len(ce):
            return
        best = -np.inf
        for t in np.geomspace(1, 300, 40):
            z = -t * (ce - ce.min(1, keepdims=True))
            like = np.mean(z[np.arange(len(z)), truth] - np.log(np.exp(z).sum(1)))
            if like > best:
                best, self.temperature = like, float(t)
        for k in range(len(self.langs)):
            on = (truth == k) & (ce.argmin(1) == k)   # a label that another model beats says nothing about this one
            if on.any():
                x, w = ce[on, k], n[on]
                middle = float(np.median(x))
                self.spread[k] = max(1.4826 * float(np.median(np.abs(x - middle) * np.sqrt(w))), 0.5)
                # some labels are wrong: the highest few per cent of a language's rows do not set its bound
                high = float(np.quantile(x - SIGMAS * self.spread[k] / np.sqrt(w), QUANTILE))
                self.bound[k] = max(middle, high) + SLACK

        some = np.isfinite(self.bound)  # a language without calibration rows takes the loosest
        if some.any():
            self.bound[~some], self.spread[~some] = self.bound[some].max(), self.spread[some].max()

    def entropies(self, arr):
        """:meth:`cross_entropy` of a string array; long texts in parts."""
        total, n, has = np.zeros((len(arr), len(self.langs))), np.zeros(len(arr), np.int64), np.zeros(len(arr), bool)
        for i, j, texts, lead in _chunks(arr):
            ce, k, h = self.cross_entropy(texts, lead)
            total[i:j] += ce * k[:, None]
            n[i:j] += k
            has[i:j] |= h
        return total / np.maximum(n, 1)[:, None], n, has

    def judge(self, texts):
        """(language, score, cross-entropy, rejected) of strings (or an array of them)."""
        ce, n, has = self.entropies(texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.string()))
        if not self.langs:
            z = np.zeros(len(texts))
            return ["und"] * len(texts), z, z, np.ones(len(texts), bool)
        k = ce.argmin(1)
        low = ce.min(1)
        score = 1.0 / np.exp(-self.temperature * (ce - low[:, None])).sum(1)
        far = low > self.bound[k] + SIGMAS * self.spread[k] / np.sqrt(np.maximum(n, 1))
        names = [self.langs[i] if h else "und" for i, h in zip(k.tolist(), has.tolist(), strict=True)]
        return names, np.where(has, score, 0.0), np.where(has, low, 0.0), far | ~has


def _strings(arr) -> list[str]:
    return [x or "" for x in arr.to_pylist()]


#: Bytes of text that are looked at together.
CHUNK = 300_000


def _chunks(arr, limit: int | None = None):
    """(first row, end row, texts, lead) of an array: several rows at a time, or a
    part of a long one with the symbols before it."""
    limit = limit or CHUNK
    data, off = text_buffer(arr)
    for i, j in slices(off, limit):
        if off[j] - off[i] <= limit:
            yield i, j, _strings(arr.slice(i, j - i)), None
            continue
        row, lead = data[off[i]:off[j]], np.full(ORDER - 1, START, np.uint32)
        for a, b in text_parts(row, limit=limit):
            text = row[a:b].tobytes().decode("utf-8", "replace")
            yield i, j, [text], lead
            lead = np.concatenate((lead, symbols([text])[0][ORDER - 1:]))[1 - ORDER:]


def _count(batches):
    for b in batches:
        lang = b.column(0).to_pylist()
        for name in sorted(set(lang)):
            mine = b.column(1).filter(pa.array([x == name for x in lang]))
            for _, _, texts, lead in _chunks(mine):
                padded, at, _, _ = symbols(texts, lead)
                if not len(at):
                    continue
                v = padded.astype(np.uint64)
                h = gram_hash([v[at - j] for j in range(ORDER)])
                _, first, many = np.unique(h, return_index=True, return_counts=True)
                g = np.stack([padded[at[first] - j] for j in range(ORDER - 1, -1, -1)], 1).astype("<u4")
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(g)), pa.array([x.tobytes() for x in g], pa.binary()), pa.array(many)], ["lang", "gram", "n"])


def train(docs: DataFrame, is_training: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          train_chars: int = TRAIN_CHARS, calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """Fits on a bounded sample: about ``train_chars`` characters per language,
    taken by a hash of id and text, and at least the row of the smallest hash; rows
    that repeat both count once, so the sample stays bounded whatever repeats."""
    d = docs.select(F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).bitwiseAND((1 << 63) - 1).alias("h"), F.col(text).alias("t"), F.col(lang).alias("l"),
                    is_training.alias("ok")).where("ok AND l IS NOT NULL AND t IS NOT NULL")
    stats = d.groupBy("l").agg(F.sum(F.length("t")).alias("chars"), F.min("h").alias("low"), F.count(F.lit(1)).alias("rows")).collect()
    stats = sorted(stats, key=lambda r: r.l)
    if not stats:
        return Model([], [])
    top = 2.0**63
    cut = reduce(lambda c, r: c.when(F.col("l") == r.l, F.lit(int(max(r.low, min(1.0, train_chars / max(r.chars, 1)) * (top - 1024))))),
                 stats[1:], F.when(F.col("l") == stats[0].l, F.lit(int(max(stats[0].low, min(1.0, train_chars / max(stats[0].chars, 1)) * (top - 1024))))))
    sample = d.where(F.col("h") <= cut).dropDuplicates(["l", "h"]).select("l", "t", (F.col("h") % 5 == 0).alias("c"))
    grams = (sample.where("NOT c").select("l", "t").mapInArrow(lean(_count), "lang string, gram binary, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    # a language whose rows were all held back trains on them, and does not calibrate
    lost = sorted({r.l for r in stats} - set(grams.column("lang").unique().to_pylist()))
    if lost:
        more = (sample.where(F.col("l").isin(lost)).select("l", "t").mapInArrow(lean(_count), "lang string, gram binary, n long")
                .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
        grams = pa.concat_tables([grams, more])
    grams = grams.combine_chunks()
    coded = grams.column("lang").combine_chunks().dictionary_encode()
    names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    mat = text_buffer(grams.column("gram"))[0].view("<u4").reshape(-1, ORDER)
    n = grams.column("n").to_numpy()
    langs = sorted(names)
    model = Model(langs, [(mat[code == names.index(x)], n[code == names.index(x)]) for x in langs])
    del grams, coded, code, mat, n
    share = min(1.0, calibration_rows / max(sum(r.rows for r in stats), 1))
    held = d.where(~F.col("l").isin(lost) & (F.col("h") % 5 == 0) & (F.col("h") <= int(max(share * (top - 1024), max(r.low for r in stats))))).dropDuplicates(["l", "h"])
    bc = docs.sparkSession.sparkContext.broadcast(model)

    def entropies(batches):
        m = bc.value
        for b in batches:
            mine = b.column(0).to_pylist()
            ce, k, has = m.entropies(b.column(1))
            on = [i for i in range(len(mine)) if has[i] and mine[i] in m.langs]
            yield pa.RecordBatch.from_arrays([pa.array([m.langs.index(mine[i]) for i in on], pa.int32()), pa.array(k[on], pa.int64()),
                                              pa.array([ce[i].tolist() for i in on], pa.list_(pa.float64()))], ["truth", "n", "ce"])

    rows = held.select("l", "t").mapInArrow(lean(entropies), "truth int, n long, ce array<double>").collect()
    if rows:
        model.calibrate(np.array([r.ce for r in rows]), np.array([r.n for r in rows], float), np.array([r.truth for r in rows]))
    bc.unpersist()
    return model


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
          T.StructField("cross_entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType())]


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) plus lang_pred, score, cross_entropy, rejected.

    A narrow map; the model, bounded by ``train_chars``, is broadcast."""
    bc = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = bc.value

        def f(arr):
            names, score, ce, far = m.judge(arr)
            return [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(ce, pa.float64()), pa.array(far, pa.bool_())]
        return f

    return map_text(docs, text, docs.columns if keep is None else keep, FIELDS, make)


def op1(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    model = train(docs, ~held)
    r = identify(docs, model, keep=["doc_id"])
    return r.select("doc_id", held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
