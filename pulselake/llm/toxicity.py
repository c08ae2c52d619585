"""Toxicity by class-conditional Kneser-Ney models of the letters of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pulselake.llm.vectorized import BASE, LETTER, LOWER, blocks, hash_words, mix, words

ORDERS = (2, 3, 4, 5, 6)  # bytes; all back off to counts of three bytes that the classes share
DISCOUNT = 0.75
LONGEST = 40  # bytes of a word that are scored at a time; longer runs are cut into pieces
FIT_DOCS, CALIBRATE_DOCS = 2000, 1500  # labelled rows of each class, at most
CACHE_WORDS = 1 << 20
EDGE = 0x20  # stands before and after each word
CONTEXT = max(ORDERS) - 1  # bytes before a byte that its probability depends on


class Pieces:
    """Words cut after every LONGEST bytes: where each piece lies, and whether its word goes on."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray):
        n = np.maximum(1, -(-(ends - starts) // LONGEST))
        self.word = np.repeat(np.arange(len(starts)), n)  # the word's number
        self.first = np.concatenate([[0], np.cumsum(n)])  # the number of each word's first piece
        nth = np.arange(len(self.word)) - self.first[self.word]
        self.starts = starts[self.word] + nth * LONGEST
        self.ends = np.minimum(self.starts + LONGEST, ends[self.word])
        self.opens, self.closes = nth == 0, self.ends == ends[self.word]

    def __getitem__(self, some: np.ndarray) -> Pieces:
        part = object.__new__(Pieces)
        for name in ("word", "starts", "ends", "opens", "closes"):
            setattr(part, name, getattr(self, name)[some])
        return part

    def hashes(self, lower: np.ndarray) -> np.ndarray:
        """A hash of all that a piece's probability depends on; a whole word's is that of its bytes."""
        h = hash_words(lower, self.starts - np.where(self.opens, 0, CONTEXT), self.ends)
        kind = (2 * ~self.opens + ~self.closes).astype(np.uint64)
        return np.where(kind > 0, mix(h + kind * BASE), h)


def _padded(data: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matrix, length, target): each piece as a row, from column ``target`` on.

    Before it stands an edge, or the CONTEXT bytes before it in its word; behind it an
    edge if the word ends there.
    """
    target = np.where(pieces.opens, 1, CONTEXT)
    begin = pieces.starts - np.where(pieces.opens, 0, CONTEXT)
    size = pieces.ends - begin
    shift = pieces.opens.astype(np.int64)
    length = size + shift + pieces.closes
    m = np.full((len(begin), int(length.max(initial=0))), EDGE, np.uint8)
    for j in range(int(size.max(initial=0))):
        here = np.flatnonzero(size > j)
        m[here, j + shift[here]] = LOWER[data[begin[here] + j]]
    return m, length, target


def _grams(m: np.ndarray, length: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of context and byte, hash of context, valid) of each byte behind ``order`` - 1 others."""
    last = m.shape[1] - order + 1
    if last <= 0:
        none = np.zeros((len(m), 0), np.uint64)
        return none, none, none.astype(bool)
    context = np.full((len(m), last), order, np.uint64)
    for j in range(order - 1):
        context = context * BASE + m[:, j:j + last].astype(np.uint64) + np.uint64(1)
    whole = mix(context * BASE + m[:, order - 1:order - 1 + last].astype(np.uint64) + np.uint64(1))
    valid = np.arange(last)[None, :] + order <= length[:, None]
    return whole, mix(context), valid


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.stack([np.bincount(at, v, len(found)) for v in values.T], 1)


class Table:
    """Values by uniform 64-bit key: a slot for each leading bits, a short search within."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, np.concatenate([values, np.zeros((1, values.shape[1]))]).astype(np.float32)
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        """Rows of values, zeros for keys that are not there."""
        slot = (keys >> self.shift).astype(np.int64)
        at, stop = self.first[slot], self.first[slot + 1]
        out = np.full(len(keys), len(self.keys))
        todo = np.flatnonzero(at < stop)
        while len(todo):
            hit = self.keys[at[todo]] == keys[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            at[todo] += 1
            todo = todo[at[todo] < stop[todo]]
        return self.values[out]


def _by_length(pieces: Pieces, most: int = 20000) -> list[np.ndarray]:
    """Numbers of the pieces in parts of like length."""
    order = np.argsort(pieces.ends - pieces.starts, kind="stable")
    return np.array_split(order, max(1, len(order) // most)) if len(order) else []


class Model:
    """Counts of both classes by order, and the shared counts; columns are ordinary, toxic."""

    def __init__(self, vocabulary: list[bytes], counts: np.ndarray, trigrams: np.ndarray, seen: np.ndarray):
        """``counts`` of the words in each class; ``trigrams`` (24 bits) as often as ``seen``."""
        data = np.frombuffer(b"".join(vocabulary), np.uint8)
        size = np.array([len(w) for w in vocabulary], np.int64)
        ends = np.cumsum(size)
        pieces = Pieces(ends - size, ends)
        parts = [(pieces.word[part], *_padded(data, pieces[part])) for part in _by_length(pieces)]
        self.grams: dict[int, Table] = {}
        self.contexts: dict[int, Table] = {}  # counts, then distinct followers
        for order in ORDERS:
            found = []
            for part, m, length, target in parts:
                whole, context, valid = _grams(m, length, order)
                # What ends before the piece is counted in the one before.
                valid &= np.arange(valid.shape[1])[None, :] + order > target[:, None]
                n = counts[part][np.nonzero(valid)[0]].astype(np.float32)
                if order < max(ORDERS):
                    # Below the top order a gram counts once for each byte before it (the
                    # continuation count); the first gram of a word has none and counts as one.
                    longer = np.zeros(valid.shape, np.uint64)
                    if valid.shape[1] > 1:
                        longer[:, 1:] = _grams(m, length, order + 1)[0]
                    found.append((whole[valid], context[valid], n, longer[valid]))
                else:
                    found.append((whole[valid], context[valid], n))
            whole, context, n, *longer = (np.concatenate(x) for x in zip(*found))
            del found
            if longer:
                for c in (0, 1):
                    n[:, c] = _first_marks(mix(whole) ^ longer[0], n[:, c] > 0)
            grams, at = np.unique(whole, return_index=True)
            n = _sums(whole, n)[1]
            self.grams[order] = Table(grams, n)
            self.contexts[order] = Table(*_sums(context[at], np.concatenate([n, n > 0], 1)))
        self.shared = Table(*_sums(mix(trigrams.astype(np.uint64)), seen[:, None]))
        self.shared_contexts = Table(*_sums(mix((trigrams >> 8).astype(np.uint64)),
                                            np.stack([seen, np.ones(len(seen))], 1)))

    def word_ratios(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary), the edge behind it included."""
        pieces = Pieces(starts, ends)
        return np.bincount(pieces.word, self.piece_ratios(data, pieces), len(starts))

    def piece_ratios(self, data: np.ndarray, pieces: Pieces) -> np.ndarray:
        """The part of each piece in its word's ratio."""
        out = np.zeros(len(pieces.starts))
        for part in _by_length(pieces):
            m, length, target = _padded(data, pieces[part])
            columns = np.arange(m.shape[1])[None, :]
            row, column = np.nonzero((columns >= target[:, None]) & (columns < length[:, None]))
            p = np.full(len(row), 1 / 256)
            far = np.flatnonzero(column >= 2)
            r, j = row[far], column[far]
            two = (m[r, j - 2].astype(np.uint64) << np.uint64(8)) | m[r, j - 1]
            n = self.shared[mix((two << np.uint64(8)) | m[r, j])][:, 0]
            c, t = self.shared_contexts[mix(two)].T
            p[far] = (np.maximum(n - DISCOUNT, 0) + (DISCOUNT * t + 1e-3) / 256) / (c + 1e-3)
            p = np.stack([p, p], 1)
            for order in ORDERS:
                whole, context, _ = _grams(m, length, order)
                here = np.flatnonzero(column >= order - 1)
                if not len(here):
                    break
                spot = row[here], column[here] - (order - 1)
                n, c = self.grams[order][whole[spot]], self.contexts[order][context[spot]]
                c, t = c[:, :2], c[:, 2:]
                higher = (np.maximum(n - DISCOUNT, 0) + DISCOUNT * t * p[here]) / np.maximum(c, 1e-9)
                p[here] = np.where(c > 0, higher, p[here])
            out[part] = np.bincount(row, np.log(p[:, 1]) - np.log(p[:, 0]), len(part))
        return out


def _first_marks(keys: np.ndarray, there: np.ndarray) -> np.ndarray:
    """1.0 at the first place of each key among those ``there``, else 0."""
    marks = np.zeros(len(keys))
    spots = np.flatnonzero(there)
    marks[spots[np.unique(keys[spots], return_index=True)[1]]] = 1
    return marks


class Scorer:
    """Features of texts; words seen before are not scored again.

    A word of more than LONGEST bytes (text without blanks, say) counts as as many words as it has
    pieces, so that what it says in one place does not drown in the rest.
    """

    def __init__(self, model: Model):
        self.model, self.known, self.ratios = model, np.zeros(0, np.uint64), np.zeros(0)

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: mean ratio of its words, mean of what exceeds 3, log of their number (-1: none)."""
        lower = LOWER[data]
        starts, ends, first = words(lower, offsets, LETTER)
        pieces = Pieces(starts, ends)
        first = pieces.first[first]
        out = np.zeros((len(offsets) - 1, 3))
        out[:, 2] = -1
        if not len(starts):
            return out
        hashes, at, back = np.unique(pieces.hashes(lower), return_index=True, return_inverse=True)
        new = ~np.isin(hashes, self.known, assume_unique=True)
        if len(self.known) + new.sum() > CACHE_WORDS:
            self.known, self.ratios, new = np.zeros(0, np.uint64), np.zeros(0), np.ones(len(hashes), bool)
        fresh = self.model.piece_ratios(lower, pieces[at[new]])
        known = np.concatenate([self.known, hashes[new]])
        order = np.argsort(known)
        self.known, self.ratios = known[order], np.concatenate([self.ratios, fresh])[order]
        ratio = self.ratios[np.searchsorted(self.known, hashes)][back]
        n = np.maximum(np.diff(first), 1)
        sums = np.concatenate([[0], np.cumsum(ratio)])
        strong = np.concatenate([[0], np.cumsum(np.maximum(ratio - 3.0, 0))])
        out[:, 0] = (sums[first[1:]] - sums[first[:-1]]) / n
        out[:, 1] = (strong[first[1:]] - strong[first[:-1]]) / n
        out[:, 2] = np.where(np.diff(first) > 0, np.log(n), -1)
        return out


def shared_counts(docs: DataFrame) -> DataFrame:
    """(gram, n): how often each three bytes stand in the words of all ``docs``.

    Tasks count before the shuffle; there are 2 ** 24 such grams at most. A task adds in place to one
    table of 32 bits and puts it out before a count can pass them.
    """
    def rows(counts: np.ndarray) -> pa.RecordBatch:
        grams = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(grams, pa.int64()), pa.array(counts[grams].astype(np.int64))], ["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = np.zeros(1 << 24, np.uint32), 0
        for _, data, offsets in blocks(batches, 0):
            if held + len(data) >= 1 << 32:
                yield rows(counts)
                counts[:], held = 0, 0
            held += len(data)
            starts, ends, _ = words(data, offsets, LETTER)
            if not len(starts):
                continue
            # A word's bytes with an edge on both sides: the byte next to it, if it is one.
            lower = np.full(len(data) + 2, EDGE, np.uint8)
            lower[1:-1] = np.where(LETTER[data], LOWER[data], EDGE)
            b = lower.astype(np.int32)
            three = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
            np.add.at(counts, three[lower[1:-1] != EDGE], np.uint32(1))
        yield rows(counts)

    return (docs.selectExpr("cast(text as string) text").mapInArrow(run, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")))


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, ordinary, toxic): how often each word stands in the texts of each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, 0):
            lower = LOWER[data]
            starts, ends, first = words(lower, offsets, LETTER)
            toxic = np.repeat(np.asarray(rows.column(1)) == 1, np.diff(first))
            hashes, at, back = np.unique(hash_words(lower, starts, ends), return_index=True, return_inverse=True)
            raw = lower.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([raw[a:b] for a, b in zip(starts[at], ends[at])], pa.binary()),
                 *[pa.array(np.bincount(back, kind, len(at)).astype(np.int64)) for kind in (~toxic, toxic)]],
                ["word", "ordinary", "toxic"])

    return (sample.selectExpr("cast(text as string) text", "toxic").mapInArrow(run, "word binary, ordinary long, toxic long")
            .groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")))


def _inputs(x: np.ndarray) -> np.ndarray:
    """What the calibration sees of the features: bounded, with a constant."""
    return np.stack([np.ones(len(x)), np.clip(x[:, 0], -2, 2), np.log(x[:, 1] + 0.003), x[:, 2] / 4], 1)


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton's method."""
    z, w = _inputs(x), np.zeros(4)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + 0.05 * w
        w = w - np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(4), gradient)
    return w


def held_out(doc_id: str = "doc_id"):
    """Whether labels of the row are kept from training."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, calibrate_docs: int = CALIBRATE_DOCS):
    """(model, weights), or the constant score where a class has no labels to learn from.

    Each class's model holds the words of at most ``fit_docs`` labelled texts, chosen by a
    hash of the id, and ``calibrate_docs`` others of each class set the threshold; so what
    comes to the driver is bounded. The lowest counts are shared by both classes and are
    taken over all ``docs``.
    """
    spark = docs.sparkSession
    usable = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    chosen = []
    for kind in (0, 1):
        ids = usable.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs + calibrate_docs)
        ids = [r["doc_id"] for r in ids.collect()]
        cut = len(ids) * fit_docs // (fit_docs + calibrate_docs)
        chosen += [(i, kind, k < cut) for k, i in enumerate(ids)]
    sample = F.broadcast(spark.createDataFrame(chosen, "id long, toxic int, fit boolean"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).join(sample, "id")
    found = word_counts(texts.filter("fit")).toArrow()
    counts = np.stack([found[c].to_numpy() for c in ("ordinary", "toxic")], 1).astype(float)
    if not counts.sum(0).all():
        return None, float(bool(counts.sum()) and not counts[:, 0].any())
    vocabulary = found["word"].to_pylist()
    del found
    grams = shared_counts(docs).toArrow()
    three, seen = grams["gram"].to_numpy(), grams["n"].to_numpy().astype(float)
    del grams
    model = Model(vocabulary, counts, three, seen)
    rows = features(texts.filter("NOT fit").select("text", "toxic"), model).collect()
    if len({r["toxic"] for r in rows}) < 2:
        rows = features(texts.select("text", "toxic"), model).collect()
    return model, calibrate(np.array([[r["a"], r["b"], r["c"]] for r in rows]), np.array([r["toxic"] for r in rows], float))


def features(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but the text (the first one), with features a, b and c."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for rows, data, offsets in blocks(batches, 0):
            x = scorer.features(data, offsets)
            yield pa.RecordBatch.from_arrays([*rows.columns[1:], *[pa.array(v) for v in x.T]], [*kept, "a", "b", "c"])

    added = [StructField(name, DoubleType()) for name in "abc"]
    return docs.mapInArrow(run, StructType([*docs.schema.fields[1:], *added]))


def _scored(rows: DataFrame, docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``rows`` (text first) with a score in the text's place, by a model trained on ``docs``."""
    model, weights = train(docs, labels, **how)
    if model is None:
        return rows.select(*rows.columns[1:], F.lit(weights).alias("score"))
    w = [float(v) for v in weights]
    z = (F.lit(w[0]) + w[1] * F.greatest(F.lit(-2.0), F.least(F.lit(2.0), F.col("a")))
         + w[2] * F.log(F.col("b") + 0.003) + w[3] * F.col("c") / 4)
    return features(rows, model).select(*rows.columns[1:], F.when(F.col("c") < 0, 0.0).otherwise(1 / (1 + F.exp(-z))).alias("score"))


def score(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    score compares the length-normalised log-likelihoods of the text's words under a toxic
    and an ordinary Kneser-Ney model, over all letters of each word, so that rare words get
    their probability from their parts; 1 if >= 0.5 is predicted. Texts without words score 0. Labels are taken from rows that are not held out. Without
    labels of both classes the score is constant. Repeated rows each get their line.
    """
    scored = _scored(docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id")),
                     docs, labels, **how)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, all columns unchanged."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.struct(*docs.columns).alias("row"))
    return _scored(rows, docs, labels, **how).filter("score < 0.5").select("row.*")
