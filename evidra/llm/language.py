"""Language of each word and text by a linear-chain conditional random field.

A word's features are its affixes (first and last one to three bytes), its three-byte n-grams
(weighted by their number) and itself (the lexicon), hashed into 2**BITS buckets of learned weights;
transitions between the languages of neighbouring words are learned with them. Forward-backward gives
each word's posteriors; a text's language is the one with the largest mean posterior, its score.

The field is fitted on the driver on at most DOCS texts of known language (the smallest hashes of
their ids, equally many of each language; texts of LEAST to MOST code points first, others where a
language has too few of these, and of longer ones the first MOST); every text is then read whole. All texts of about GROUP bytes go through forward-backward together, step by step.

Defined results: more than LANGUAGES languages are an error; null texts and texts without a letter are `und` with score 0, as is everything if
there is nothing to learn from; equal posteriors go to the first language by name; repeated rows are
rows of their own; an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W

BITS, DOCS, LEAST, MOST, EPOCHS, RATE, DECAY, GROUP = 18, 1600, 100, 12_000, 3, 0.15, 1e-6, 8 << 20
#: The most languages; a model holds 2**(BITS + 1) weights of each.
LANGUAGES = 64
UNKNOWN = "und"
_TAGS = np.random.default_rng(11).integers(1, 2**63, 8, np.uint64)
_LETTER = np.zeros(256, np.int64)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def featurize(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of each word, n-gram buckets by place, words' starts, ends of their n-grams, words' ends, each text's first word)."""
    starts, ends, _ = W.split(data, bounds)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    ok = letters[ends] > letters[starts]
    starts, ends = starts[ok], ends[ok]
    first = np.searchsorted(starts, bounds)
    up, down = W._power(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(W.LOWER_BYTE[data] * up[: len(data)], out=total[1:])
    part = lambda a, b, tag: (W.mix((total[b] - total[a]) * down[a] ^ _TAGS[tag]) >> np.uint64(64 - BITS)).astype(np.int32)
    buckets = np.stack([part(starts, ends, 0), *(part(starts, np.minimum(starts + k, ends), k) for k in (1, 2, 3)), *(part(np.maximum(ends - k, starts), ends, 3 + k) for k in (1, 2, 3))], axis=1)
    places = np.arange(max(0, len(data) - 2))
    return buckets, part(places, places + 3, 7), starts, np.maximum(ends - 2, starts), ends, first


class Field:
    def __init__(self, langs: list[str]):
        self.langs, k = langs, len(langs)
        self.word = np.zeros((1 << BITS, k), np.float32)
        self.gram = np.zeros((1 << BITS, k), np.float32)
        self.step = np.zeros((k, k))

    def emissions(self, f) -> np.ndarray:
        buckets, grams, starts, last, _, _ = f
        e = self.word[buckets[:, 0]]
        for c in range(1, buckets.shape[1]):
            e += self.word[buckets[:, c]]
        total = np.zeros((len(grams) + 1, len(self.langs)), np.float64)
        np.cumsum(self.gram[grams], axis=0, out=total[1:], dtype=np.float64)
        last = np.minimum(last, len(grams))
        return e + (total[last] - total[np.minimum(starts, last)]) / np.maximum(last - starts, 1)[:, None]

    def posteriors(self, e: np.ndarray, first: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Each word's posteriors and, if asked for, the expected number of each transition."""
        k, n = len(self.langs), np.diff(first)
        order = np.argsort(-n, kind="stable")
        n_sorted = n[order]
        steps = int(n_sorted[0]) if len(n) else 0
        active = np.searchsorted(-n_sorted, -np.arange(steps), "left") if steps else np.zeros(0, int)
        at = np.concatenate([[0], np.cumsum(active)])
        # by step: the words of the texts that are that long, longest text first
        rank = np.empty(len(n), np.int64)
        rank[order] = np.arange(len(n))
        t = np.arange(len(e)) - np.repeat(first[:-1], n)
        place = at[t] + np.repeat(rank, n)
        p = np.empty((len(e), k))
        p[place] = np.exp(e - e.max(axis=1, keepdims=True))
        move = np.exp(self.step - self.step.max())
        alpha = np.empty_like(p)
        for i in range(steps):
            a = p[at[i] : at[i + 1]] if i == 0 else (alpha[at[i - 1] : at[i - 1] + active[i]] @ move) * p[at[i] : at[i + 1]]
            np.divide(a, a.sum(axis=1, keepdims=True), out=alpha[at[i] : at[i + 1]])
        beta = np.ones((active[0] if steps else 0, k))
        moves = np.zeros((k, k))
        for i in range(steps - 1, -1, -1):
            m = active[i]
            if i < steps - 1:
                nxt = active[i + 1]
                pb = p[at[i + 1] : at[i + 2]] * beta[:nxt]
                if pairs:
                    x = alpha[at[i] : at[i] + nxt][:, :, None] * move * pb[:, None, :]
                    moves += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                b = pb @ move.T
                beta[:nxt] = b / b.sum(axis=1, keepdims=True)
            alpha[at[i] : at[i] + m] *= beta[:m]
        alpha /= alpha.sum(axis=1, keepdims=True)
        return alpha[place], moves

    def fit(self, texts: list[str], langs: list[str], epochs: int = EPOCHS) -> "Field":
        """Gradient ascent on the labels' likelihood, every word of a text having the text's language."""
        rng, k = np.random.default_rng(5), len(self.langs)
        y_of = {x: i for i, x in enumerate(self.langs)}
        seen = {"word": np.full_like(self.word, 1e-2), "gram": np.full_like(self.gram, 1e-2), "step": np.full_like(self.step, 1e-2)}

        def climb(name: str, grad: np.ndarray) -> None:
            w = getattr(self, name)
            seen[name] += grad * grad
            w += RATE * grad / np.sqrt(seen[name]) - DECAY * w

        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for lo in range(0, len(order), 64):
                some = order[lo : lo + 64]
                raw = [texts[i].encode() for i in some]
                bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
                f = featurize(np.frombuffer(b"".join(raw), np.uint8), bounds)
                buckets, grams, starts, last, _, first = f
                if not len(starts):
                    continue
                y = np.repeat([y_of[langs[i]] for i in some], np.diff(first))
                post, moves = self.posteriors(self.emissions(f), first, pairs=True)
                g = np.eye(k)[y] - post
                grad = lambda b, v: np.stack([np.bincount(b, v[:, c], 1 << BITS) for c in range(k)], axis=1)
                climb("word", grad(buckets.T.reshape(-1).astype(np.int64), np.tile(g, (buckets.shape[1], 1))).astype(np.float32))
                size = np.maximum(last - starts, 0)
                at = np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                climb("gram", grad(grams[at].astype(np.int64), np.repeat(g / np.maximum(size, 1)[:, None], size, axis=0)).astype(np.float32))
                own = np.zeros((k, k))
                stay = np.diff(first) - 1
                np.add.at(own, ([y_of[langs[i]] for i in some],) * 2, np.maximum(stay, 0))
                climb("step", (own - moves) / max(1, len(starts)))
        return self


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Field | None:
    """The field fitted on a bounded sample of what is not held out; None if there is nothing to learn from."""
    known = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(lang_col).count().limit(LANGUAGES + 1).collect()}
    if not sizes:
        return None
    if len(sizes) > LANGUAGES:
        raise ValueError(f"{lang_col} has more than {LANGUAGES} values")
    each, cells = max(1, DOCS // len(sizes)), 1 << 20
    cut = F.create_map(*(x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(cells, -(-cells * 3 * each // n))))))
    h = F.xxhash64(id_col)
    drawn = known.where((F.pmod(h, F.lit(cells)) < cut[F.col(lang_col)])).select(F.col(lang_col).alias("lang"), F.substring(text_col, 1, MOST).alias("text"), h.alias("h"), F.length(text_col).between(LEAST, MOST).alias("fits"))
    best = Window.partitionBy("lang").orderBy(F.desc("fits"), "h", "text")
    rows = drawn.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= each).orderBy("lang", "nth").collect()
    langs = sorted({r.lang for r in rows})
    return Field(langs).fit([r.text for r in rows], [r.lang for r in rows]) if langs else None


def predict(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score and, if asked for, spans: runs of words of one language (start, end in bytes of UTF-8, lang)."""
    shape = "doc_id bigint, lang_pred string, score double" + (", spans array<struct<start:bigint,end:bigint,lang:string>>" if spans else "")
    if field is None:
        out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        return out.withColumn("spans", F.lit(None).cast("array<struct<start:bigint,end:bigint,lang:string>>")) if spans else out
    shared = docs.sparkSession.sparkContext.broadcast((field.langs, field.word, field.gram, field.step))

    def run(batches):
        import pyarrow as pa

        model = Field([])
        model.langs, model.word, model.gram, model.step = shared.value
        names = np.array([*model.langs, UNKNOWN], object)
        for b in batches:
            for a, z, data, bounds in W.texts(b.column(1), GROUP):
                e, first, where = [], [0], []
                lo = 0
                while lo < z - a:  # emissions by the half megabyte, forward-backward over the whole group
                    hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + (1 << 19), "right")) - 1)
                    f = featurize(data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
                    e.append(model.emissions(f))
                    first += (f[5][1:] + first[-1]).tolist()
                    where += [(f[2] + bounds[lo], f[4] + bounds[lo])] if spans else []
                    lo = hi
                e, first = np.concatenate(e), np.array(first)
                post, _ = model.posteriors(e, first)
                n = np.diff(first)
                total = np.concatenate([np.zeros((1, post.shape[1])), np.cumsum(post, axis=0)])
                mean = (total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)[:, None]
                best = mean.argmax(axis=1)
                score = np.clip(mean[np.arange(len(n)), best], 0, 1)
                for i in np.flatnonzero(~np.logical_or.reduceat(np.concatenate([_ASCII[data], [False]]), bounds[:-1]) | (np.diff(bounds) == 0) | (n == 0)):
                    if not n[i] or not any(c.isalpha() for c in data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace")):
                        best[i], score[i] = len(model.langs), 0.0
                cols = [b.column(0)[a:z], pa.array(names[best], pa.string()), pa.array(score)]
                if spans:
                    tag = post.argmax(axis=1)
                    s, t = (np.concatenate(x) for x in zip(*where))
                    runs = []
                    for i, j, d in zip(first[:-1], first[1:], bounds[:-1]):
                        cut = [i, *(np.flatnonzero(np.diff(tag[i:j])) + i + 1), j] if j > i else []
                        runs.append([{"start": int(s[x] - d), "end": int(t[y - 1] - d), "lang": model.langs[tag[x]]} for x, y in zip(cut[:-1], cut[1:])])
                    cols.append(pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "lang_pred", "score", *["spans"] * spans])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, shape)


_ASCII = np.zeros(256, bool)
_ASCII[[*range(65, 91), *range(97, 123)]] = True
