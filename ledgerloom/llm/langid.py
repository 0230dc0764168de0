"""Language of a text by the nearest of several centroids per language.

A text is the vector of its letter n-grams (one to GRAM characters, word ends counted as blanks), hashed to BUCKETS places,
each weighed by log(1 + count) times its inverse document frequency, of length one.  Every language has up to CLUSTERS
centroids, as prose, lists and license texts of one language lie apart.  A text is given the language of the centroid with
the largest cosine; if that is well below what nearly all texts of that language and length have, the text is rejected as
too far from all centroids.

Frequencies, centroids and the distances of rejection are worked out over all texts to learn from.  Only the clusters'
starting points come from a bounded sample, SEEDS texts of a language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import partitions, sent, slices
from ledgerloom.session import stage

GRAM = 3
BUCKETS = 1 << 14
CLUSTERS = 4  # of a language, at most
SEEDS = 300  # texts of a language, on average, that its clusters start from
ROUNDS = 12  # of clustering the sample
LANGUAGES = 500  # at most; of more labels those with the most texts are learned
FOLDS, HELD_OUT = 4, 2
FAR, ROOM = 0.005, 1.5  # rejection lies ROOM times as far from the median cosine as the one that a share FAR of texts is below
UNKNOWN = "und"
ROWS, CHUNK = 64, 1 << 18  # texts of one table of counts, and characters read at once
UNIT = 1 << 24  # sums are of whole numbers of this part, so that their order does not matter

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def plain(text: str | None) -> str:
    """Lower-case words between single blanks; empty if the text has no letter."""
    if not text or not _LETTER.search(text):
        return ""
    return " " + _OTHER.sub(" ", text.lower()).strip() + " "


def counts(texts: list[str]) -> np.ndarray:
    """n-grams by text and bucket; a text of any length is read in chunks."""
    joined = "\0".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    out = np.zeros(len(texts) * BUCKETS, np.int64)
    for start in range(0, len(codes), CHUNK):
        part = codes[start : start + CHUNK + GRAM - 1].astype(np.uint64)
        row = np.searchsorted(ends, np.arange(start, min(start + CHUNK, len(codes))), "right")
        key, whole, places = np.zeros(len(row), np.uint64), np.ones(len(row), bool), []
        for n in range(1, GRAM + 1):
            at = part[n - 1 : n - 1 + len(row)]
            key = (key[: len(at)] + at + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
            whole = whole[: len(at)] & (at != 0)
            row = row[: len(at)]
            told = whole & ((at != 32) | (n > 1))
            places.append(row[told] * BUCKETS + (key[told] >> np.uint64(40)).astype(np.int64) % BUCKETS)
        out += np.bincount(np.concatenate(places), minlength=len(out))
    return out.reshape(len(texts), BUCKETS)


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length one; of zeros where there is nothing."""
    row, bucket = np.nonzero(found)
    weight = np.log1p(found[row, bucket]) * idf[bucket]
    size = np.sqrt(np.bincount(row, weight * weight, len(found)))
    out = np.zeros(found.shape, np.float32)
    out[row, bucket] = weight / size[row]
    return out


def clustered(rows: np.ndarray, most: int = CLUSTERS) -> np.ndarray:
    """Centroids of up to ``most`` clusters by cosine: the starts lie as far apart as they can, then means move."""
    centres = [rows.sum(0)]
    centres[0] = rows[int(np.argmax(rows @ centres[0]))]
    nearest = rows @ centres[0]
    while len(centres) < min(most, len(rows)) and nearest.min() < 1 - 1e-6:
        centres.append(rows[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, rows @ centres[-1])
    found = np.array(centres)
    for _ in range(ROUNDS):
        own = np.argmax(rows @ found.T, axis=1)
        sums = np.array([rows[own == i].sum(0) if (own == i).any() else found[i] for i in range(len(found))])
        moved = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        if np.allclose(moved, found, atol=1e-6):
            break
        found = moved
    return found


class Model:
    """Frequencies, and centroids with the language of each."""

    def __init__(self, idf: np.ndarray, names: list[str], centroids: np.ndarray):
        self.idf, self.names, self.centroids = idf, names, centroids

    def rows(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Which texts have letters, and their vectors, a few at a time."""
        told = [plain(t) for t in texts]
        with_letters = [i for i, t in enumerate(told) if t]
        for at in range(0, len(with_letters), ROWS):
            own = with_letters[at : at + ROWS]
            yield np.array(own), vectors(counts([told[i] for i in own]), self.idf)

    def nearest(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each text, -1 for one without a letter, and its cosine."""
        which, cosine = np.full(len(texts), -1), np.zeros(len(texts))
        if len(self.centroids):
            for own, rows in self.rows(texts):
                near = rows @ self.centroids.T
                which[own] = near.argmax(1)
                cosine[own] = np.clip(near.max(1), 0, 1).round(6)  # beyond that, sums depend on which texts are read together
        return which, cosine

    def predict(self, texts: list[str | None]) -> list[str]:
        return [self.names[i] if i >= 0 else UNKNOWN for i in self.nearest(texts)[0]]


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        texts = batch.column(column).to_pylist()
        for start, end in slices(texts):
            yield batch.slice(start, end - start), texts[start:end]


def frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Number of texts that hold each bucket, and of texts with a letter, over all of ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(BUCKETS, np.int64), 0
        for _, own in _texts(batches, 0):
            told = [t for t in map(plain, own) if t]
            n += len(told)
            for at in range(0, len(told), ROWS):
                held += (counts(told[at : at + ROWS]) > 0).sum(0)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(held[used], n))], names=["bucket", "n"])

    out = np.zeros(BUCKETS + 1, np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out[:-1], int(out[-1])


def _starts(learn: DataFrame, languages: list, idf: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """Centroids of a bounded sample of each language's different texts, chosen by a hash of the text."""
    spark = learn.sparkSession
    cut = [(name, int(min(1.0, SEEDS / n) * ((1 << 62) - 1))) for name, n in languages]
    cuts = spark.createDataFrame(cut, "lang string, cut long")
    digest = F.shiftright(F.xxhash64("text"), 1).bitwiseAND(F.lit((1 << 62) - 1))
    chosen = learn.withColumn("digest", digest).join(F.broadcast(cuts), "lang").where("digest <= cut")  # LANGUAGES rows at most
    sample = chosen.groupBy("lang", "digest").agg(F.min("text").alias("text"))
    model = sent(spark, Model(idf, [], np.zeros((0, BUCKETS))))

    def cluster(own: pa.Table) -> pa.Table:
        texts = own.sort_by("digest").column("text").to_pylist()
        rows = [v for _, v in model().rows(texts)]
        found = clustered(np.concatenate(rows)) if rows else np.zeros((0, BUCKETS), np.float32)
        name = own.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([name] * len(found), pa.string()), "data": pa.array([c.astype(np.float32).tobytes() for c in found], pa.binary())})

    return [(r["lang"], np.frombuffer(r["data"], np.float32)) for r in sample.groupBy("lang").applyInArrow(cluster, "lang string, data binary").collect()]


def _centred(learn: DataFrame, model: Model) -> Model:
    """The model with each centroid moved to the mean of all texts of its language that lie nearest to it.

    Tasks send one sum for each centroid; sums are added in two steps, so no task reads one from every other.
    """
    spark = learn.sparkSession
    told = sent(spark, model)
    parts = int(np.ceil(np.sqrt(partitions(spark))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = told()
        names = np.array(own.names)
        sums, salt = np.zeros(own.centroids.shape, np.int64), 0
        for batch, texts in _texts(batches, 1):
            langs = np.array(batch.column(0).to_pylist())
            for which, rows in own.rows(texts):
                near = rows @ own.centroids.T
                near[langs[which][:, None] != names[None, :]] = -1
                best = near.argmax(1)
                salt += len(which)
                whole = np.rint(rows * UNIT).astype(np.int64)
                best[near.max(1) < 0] = -1  # of a language that is not learned
                for c in np.unique(best[best >= 0]):
                    sums[c] += whole[best == c].sum(0)
        used = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.full(len(used), salt % parts)), pa.array([sums[c].tobytes() for c in used], pa.binary())], names=["centroid", "part", "data"])

    def added(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in rows.column("data").to_pylist())
        return pa.table({"centroid": [rows.column("centroid")[0].as_py()], "data": pa.array([total.tobytes()], pa.binary())})

    sums = learn.select("lang", "text").mapInArrow(run, "centroid long, part long, data binary")
    for keys in (["centroid", "part"], ["centroid"]):
        sums = sums.groupBy(*keys).applyInArrow(added, "centroid long, data binary")
    moved = model.centroids.copy()
    for r in sums.collect():
        total = np.frombuffer(r["data"], np.int64).astype(float)
        moved[r["centroid"]] = total / np.linalg.norm(total)
    return Model(model.idf, model.names, moved)


def fit(docs: DataFrame) -> Model:
    """The model of ``text, lang`` rows, those without either left out."""
    learn = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    by_size = learn.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(LANGUAGES)
    languages = [(r["lang"], r["count"]) for r in by_size.collect()]
    held, n = frequencies(learn)
    idf = np.log((1 + n) / (1 + held)) + 1
    starts = sorted(_starts(learn, languages, idf), key=lambda x: (x[0], x[1].tobytes())) if languages else []
    if not starts:
        return Model(idf, [], np.zeros((0, BUCKETS), np.float32))
    return _centred(learn, Model(idf, [name for name, _ in starts], np.array([c for _, c in starts], np.float32)))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``lang_pred``, ``score`` (the cosine) and ``n_letters``, of plain text."""
    told = sent(docs.sparkSession, model)
    others = [c for c in docs.columns if c != "text"]
    given = docs.select(*others, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = told()
        for batch, texts in _texts(batches, len(others)):
            which, cosine = own.nearest(texts)
            names = [own.names[i] if i >= 0 else UNKNOWN for i in which]
            made = [pa.array(names, pa.string()), pa.array(cosine), pa.array([len(t or "") for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*others, "lang_pred", "score", "n_chars"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    return given.mapInArrow(run, f"{kinds}, lang_pred string, score double, n_chars long")


def identified(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row; other columns play no part.

    Rows whose crc32 of the id as text, modulo FOLDS, is HELD_OUT are only predicted, as are rows with a null id, language or
    text.  ``lang_pred`` is the language of the nearest centroid, ``und`` with score 0 for a null text, one without a letter,
    or if there is nothing to learn from.  ``rejected`` is whether the cosine is far below those of the learned texts of that
    language and as many doublings of length, or of the language where it has none of that length; ``und`` is rejected.
    """
    fold = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % FOLDS
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
        F.when(fold != HELD_OUT, F.col(f"`{lang}`")).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"),
    )
    out = stage(predicted(rows, fit(rows)), "language").withColumn("octave", F.floor(F.log2(F.col("n_chars") + 1)).cast("int"))
    known = out.where("lang_pred = lang")
    low, mid = (F.percentile_approx("score", q, 10_000) for q in (FAR, 0.5))
    lowest = mid - ROOM * (mid - low)
    classes = known.groupBy("lang", "octave").agg(lowest.alias("near")).select(F.col("lang").alias("lang_pred"), "octave", "near")
    overall = known.groupBy("lang").agg(lowest.alias("near_any")).select(F.col("lang").alias("lang_pred"), "near_any")
    # At most LANGUAGES languages times 32 lengths, so these may go to all tasks, and no language gathers in one of them.
    judged = out.join(F.broadcast(classes), ["lang_pred", "octave"], "left").join(F.broadcast(overall), "lang_pred", "left")
    far = F.col("score") < F.coalesce("near", "near_any")
    return judged.select("doc_id", "held_out", "lang_pred", "score", F.coalesce(far, F.lit(True)).alias("rejected"))
