"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model predicts the characters of words, each from up to ORDER - 1 before it, for each language on its own.  All counts
and probabilities are tables keyed by language and n-gram, made by grouping and joining, so they are sharded like any other
table.  Documents are dealt to blocks by a hash of their id, packed; a block lists its distinct n-grams once, the lists are
dealt to shards of the n-gram tables, and each block gets its probabilities back and works out its documents' perplexity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import carried, packed, partitions, unpacked
from ledgerloom.session import stage

ORDER = 4
BLOCK_BYTES = 16 << 20
QUANTILE = 0.99  # of the trusted documents of a language
MARGIN = 0.3  # nats a character above that quantile up to which a document passes
SLACK = 3.0  # a document of n characters may exceed the quantile by SLACK / sqrt(n) nats for each character
LEAST_DOCS = 50  # trusted documents that a language needs for a quantile of its own
SPLIT_BYTES = 1 << 20  # of a text that are cut into words at once
TABLE = 1 << 24  # keys are ranked by a table of as many places at most, by sorting beyond
BLANK = re.compile(rb"[\x20\x09-\x0D]")
FOUND = {"doc_id": pa.int64(), "lang": pa.string(), "n_words": pa.int64(), "n_symbols": pa.int64(), "logp": pa.float64()}


def padded(word: str) -> str:
    return " " * (ORDER - 1) + word + " "


def grams(word: str) -> list[str]:
    """All n-grams of a word, one for each of its characters and one for its end."""
    text = padded(word)
    return [text[i : i + ORDER] for i in range(len(word) + 1)]


def _dealt(docs: DataFrame, doc_id: str, text: str, lang: str, blocks: int) -> DataFrame:
    """Documents in packed blocks; ``docs`` holds id and language."""
    key = F.xxhash64(F.col(f"`{doc_id}`").cast("long"))
    own = F.when(F.col(f"`{doc_id}`").isNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(key)
    doc = F.struct(F.col(f"`{doc_id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("lang"))
    return packed(docs.select(doc.alias("doc"), F.col(f"`{text}`").cast("binary").alias("data"), F.pmod(own, F.lit(blocks)).alias("block")))


class Words:
    """The documents of a block by language: their distinct words, and the distinct n-grams of these, as numbers.

    Texts are cut into words some SPLIT_BYTES at a time, so a long one is held as packed bytes, not as so many objects.
    """

    def __init__(self, block: pa.Table):
        self.docs = carried(block).to_pylist()
        pieces: dict[str, list] = {}
        self.sizes = np.zeros(len(self.docs), np.int64)
        for i, (doc, text) in enumerate(zip(self.docs, unpacked(block))):
            for words in _split(text):
                pieces.setdefault(doc["lang"], []).append(pa.array(words, pa.binary()))
                self.sizes[i] += len(words)
        self.langs = {lang: Distinct(own) for lang, own in sorted(pieces.items())}

    def of(self, lang: str) -> np.ndarray:
        """Numbers of the documents of a language, in turn, as its words are."""
        return np.flatnonzero([d["lang"] == lang for d in self.docs])


def _split(text: memoryview) -> Iterator[list[bytes]]:
    data, at = bytes(text), 0
    while at < len(data):
        gap = BLANK.search(data, at + SPLIT_BYTES)
        end = gap.end() if gap else len(data)
        yield data[at:end].split()
        at = end


def _ranked(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and each key's place among them; keys are below ``bound``."""
    if bound > TABLE:
        return np.unique(keys, return_inverse=True)
    seen = np.zeros(bound, bool)
    seen[keys] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[keys]


class Distinct:
    """Words of one language: ``place`` of each among the distinct ones, whose n-grams follow each other in ``gram``.

    ``lengths`` has the number of n-grams of each distinct word, ``names`` the distinct n-grams themselves.
    """

    def __init__(self, pieces: list[pa.Array]):
        coded = pa.concat_arrays(pieces).dictionary_encode()
        self.place = coded.indices.to_numpy()
        laid = " " * (ORDER - 1) + (" " * ORDER).join(w.decode("utf-8", "replace") for w in coded.dictionary.to_pylist()) + " "
        points = np.frombuffer(laid.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        blank = points == ord(" ")
        ends = np.flatnonzero(~np.append(True, blank[:-1]) | ~blank)  # where an n-gram of a word ends: a character of it, or the blank after it
        alphabet, code = _ranked(points, 0x110000)
        gram, kinds = code[ends - ORDER + 1], len(alphabet)
        for back in range(ORDER - 2, -1, -1):
            found, gram = _ranked(gram * len(alphabet) + code[ends - back], kinds * len(alphabet))
            kinds = len(found)
        first = np.empty(kinds, np.int64)
        first[gram] = ends
        spelt = points[first[:, None] + np.arange(1 - ORDER, 1)].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
        self.gram, self.names = gram, [spelt[i : i + ORDER] for i in range(0, len(spelt), ORDER)]
        self.lengths = np.diff(np.append(-1, np.flatnonzero(blank[ends])))

    def counts(self, used: np.ndarray) -> np.ndarray:
        """How often each distinct n-gram occurs in the words marked as used."""
        per_word = np.bincount(self.place[used], minlength=len(self.lengths))
        return np.bincount(self.gram, np.repeat(per_word, self.lengths), len(self.names)).astype(np.int64)


def _listed(block: pa.Table, trusted: pa.Table, shards: int) -> pa.Table:
    """Distinct n-grams of a block by language, dealt to shards, each with its count in the block's trusted documents."""
    rows = {"block": [], "lang": [], "shard": [], "grams": [], "counts": []}
    if block.num_rows:
        number, words, good = block.column("block")[0].as_py(), Words(block), set(trusted.column("id").to_pylist())
        marked = np.array([d["id"] in good for d in words.docs], bool)
        for lang, own in words.langs.items():
            docs = words.of(lang)
            counts = own.counts(np.repeat(marked[docs], words.sizes[docs]))
            shard = np.array([shard_of(g, shards) for g in own.names])
            for s in np.unique(shard).tolist():
                chosen = np.flatnonzero(shard == s).tolist()
                rows["block"].append(number)
                rows["lang"].append(lang)
                rows["shard"].append(s)
                rows["grams"].append([own.names[i] for i in chosen])
                rows["counts"].append(counts[chosen])
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()))
    return pa.table({c: pa.array(v, k) for (c, v), k in zip(rows.items(), kinds)})


def shard_of(gram: str, shards: int) -> int:
    """Shard by the code points of an n-gram, the same in Python and in ``_shard``."""
    mixed = 0
    for c in gram:
        mixed = (mixed * 31 + ord(c)) % 1_000_003
    return mixed % shards


def _shard(gram: str, shards: int) -> Column:
    points = F.transform(F.sequence(F.lit(1), F.length(gram)), lambda i: F.ascii(F.substr(F.col(gram), i, F.lit(1))).cast("long"))
    return F.aggregate(points, F.lit(0).cast("long"), lambda s, c: (s * 31 + c) % 1_000_003) % shards


def _answers(requests: pa.Table, known: pa.Table) -> pa.Table:
    """Requests with the log-probability of each n-gram, as ``values`` beside ``grams``."""
    by_lang: dict[str, dict] = {}
    for lang, gram, p in zip(*(known.column(c).to_pylist() for c in ("lang", "gram", "logp"))):
        by_lang.setdefault(lang, {})[gram] = p
    none = float("nan")
    values = [[by_lang.get(lang, {}).get(g, none) for g in own] for lang, own in zip(requests.column("lang").to_pylist(), requests.column("grams").to_pylist())]
    return pa.table({"block": requests.column("block"), "lang": requests.column("lang"), "grams": requests.column("grams"), "values": pa.array(values, pa.list_(pa.float32()))})


def _perplexities(block: pa.Table, answers: pa.Table) -> pa.Table:
    """Characters scored and their log-probability for each document; null for a language without a model."""
    known: dict[str, dict] = {}
    for lang, own, values in zip(*(answers.column(c).to_pylist() for c in ("lang", "grams", "values"))):
        known.setdefault(lang, {}).update(zip(own, values))
    if not block.num_rows:
        return pa.table({n: pa.array([], k) for n, k in FOUND.items()})
    words = Words(block)
    sizes, sums = np.zeros(len(words.docs), np.int64), np.full(len(words.docs), np.nan)
    for lang, own in words.langs.items():
        logp = np.array(list(map(known[lang].__getitem__, own.names)), float)
        begins = np.cumsum(own.lengths) - own.lengths
        per_word = np.add.reduceat(logp[own.gram], begins)
        docs = words.of(lang)
        docs = docs[words.sizes[docs] > 0]
        begins = np.cumsum(words.sizes[docs]) - words.sizes[docs]
        sizes[docs] = np.add.reduceat(own.lengths[own.place], begins)
        sums[docs] = np.add.reduceat(per_word[own.place], begins)
    columns = ([d["id"] for d in words.docs], [d["lang"] for d in words.docs], words.sizes, sizes, sums)
    return pa.table({n: pa.array(c, k, from_pandas=True) for (n, k), c in zip(FOUND.items(), columns)})


def _part(start: int, length: int) -> Column:
    return F.substring("gram", start, length)


class Model:
    """Probabilities ``p[n]`` (``lang, gram, logp``) and back-off weights ``b[n]`` (``lang, ctx, logb``) of all orders."""

    def __init__(self, counts: DataFrame, label: str):
        """``counts`` has ``lang, gram, c`` for n-grams of length ORDER."""
        tables = {ORDER: stage(counts.groupBy("lang", "gram").agg(F.sum("c").alias("c")), f"{label}-{ORDER}")}
        for n in range(ORDER - 1, 0, -1):
            # Lower orders count the different characters that an n-gram follows.
            tables[n] = stage(tables[n + 1].groupBy("lang", _part(2, n).alias("gram")).agg(F.count(F.lit(1)).alias("c")), f"{label}-{n}")
        seen = [
            t.groupBy("lang").agg(*(F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)), F.count(F.lit(1)).alias("kinds")).withColumn("n", F.lit(n))
            for n, t in tables.items()
        ]
        y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))

        def discount(k: int) -> Column:
            wanted = k - (k + 1) * y * F.col(f"n{k + 1}") / F.greatest(F.col(f"n{k}"), F.lit(1.0))
            return F.when(F.col(f"n{k}") > 0, F.greatest(F.least(wanted, F.lit(k - 0.05)), F.lit(0.05))).otherwise(F.lit(0.5))

        discounts = stage(reduce(DataFrame.unionByName, seen).select("lang", "n", "kinds", *(discount(k).alias(f"d{k}") for k in (1, 2, 3))), f"{label}-discounts")
        self.p, self.b, lower = {}, {}, None
        for n in range(1, ORDER + 1):
            of_order = discounts.where(F.col("n") == n).drop("n")
            d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
            rows = tables[n].join(of_order, "lang").select("lang", "gram", "c", "kinds", d.alias("d"), _part(1, n - 1).alias("ctx"), _part(2, n - 1).alias("rest"))
            contexts = stage(rows.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("mass"), F.max("kinds").alias("kinds")), f"{label}-contexts-{n}")
            left = F.col("mass") / F.col("total")
            self.b[n] = contexts.select("lang", "ctx", F.log(left).alias("logb"))
            joined = rows.drop("kinds").join(contexts, ["lang", "ctx"])
            if lower is None:
                below = 1 / (F.col("kinds") + 1)
                self.unknown = contexts.select("lang", F.log(left / (F.col("kinds") + 1)).alias("logp"))
            else:
                joined = joined.join(lower.select("lang", F.col("gram").alias("rest"), F.col("logp").alias("lower")), ["lang", "rest"])
                below = F.exp("lower")
            p = (F.col("c") - F.col("d")) / F.col("total") + left * below
            lower = self.p[n] = stage(joined.select("lang", "gram", F.log(p).alias("logp")), f"{label}-p-{n}")

    def resolved(self, asked: DataFrame) -> DataFrame:
        """``lang, gram, logp`` of the n-grams asked for, seen or not; none for a language without trusted text."""
        rows, ways, weight = asked, [], F.lit(0.0)
        for n in range(ORDER, 0, -1):
            p = self.p[n].select("lang", F.col("gram").alias(f"g{n}"), F.col("logp").alias(f"p{n}"))
            b = self.b[n].select("lang", F.col("ctx").alias(f"c{n}"), F.col("logb").alias(f"b{n}"))
            keyed = rows.withColumns({f"g{n}": _part(ORDER - n + 1, n), f"c{n}": _part(ORDER - n + 1, n - 1)})
            rows = keyed.join(p, ["lang", f"g{n}"], "left").join(b, ["lang", f"c{n}"], "left")
            ways.append(weight + F.col(f"p{n}"))
            if n > 1:
                weight = weight + F.coalesce(f"b{n}", F.lit(0.0))
        unknown = self.unknown.withColumnRenamed("logp", "none")
        return rows.join(unknown, "lang").select("lang", "gram", F.coalesce(*ways, weight + F.col("none")).alias("logp"))


def perplexity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "kneser") -> DataFrame:
    """``doc_id, lang, n_words, n_symbols, logp`` of every document; trusted text is that of documents labelled quality 1.

    ``docs`` should be a stored table: it is scanned and dealt twice, which takes less disk than a copy kept between the passes.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    shards = max(partitions(docs.sparkSession), 8)
    by_block = _dealt(docs, doc_id, text, lang, blocks).groupBy("block")
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id")).distinct()
    trusted = trusted.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))

    def list_grams(block: pa.Table, trusted: pa.Table) -> pa.Table:
        return _listed(block, trusted, shards)

    listed = by_block.cogroup(trusted.groupBy("block")).applyInArrow(list_grams, "block long, lang string, shard long, grams array<string>, counts array<long>")
    listed = stage(listed, f"{label}-listed")
    each = listed.select("lang", F.explode(F.arrays_zip("grams", "counts")).alias("of")).select("lang", F.col("of.grams").alias("gram"), F.col("of.counts").alias("c"))
    model = Model(each.where("c > 0"), label)
    every = stage(listed.select("lang", F.explode("grams").alias("gram")).distinct(), f"{label}-asked")
    known = stage(model.resolved(every).withColumn("shard", _shard("gram", shards)), f"{label}-known")
    asked = listed.drop("counts").groupBy("shard")
    answers = asked.cogroup(known.groupBy("shard")).applyInArrow(_answers, "block long, lang string, grams array<string>, values array<float>")
    found = by_block.cogroup(answers.groupBy("block")).applyInArrow(_perplexities, "doc_id long, lang string, n_words long, n_symbols long, logp double")
    return found.withColumn("lang", F.nullif("lang", F.lit("")))


def judged(docs: DataFrame, labels: DataFrame, label: str = "kneser") -> DataFrame:
    """One row per document: ``doc_id, lang, n_words, perplexity, threshold, kept``.

    ``perplexity`` is that of a character; ``threshold`` lies MARGIN above the QUANTILE of the trusted documents of the language, more for
    short texts, whose figures scatter.  A language with fewer than LEAST_DOCS trusted documents takes the quantile of all
    trusted documents.  Null and empty texts, and languages without any trusted text, have no perplexity and are kept, as
    nothing speaks against them.  A null language is one of its own.  Repeated rows stay.  An empty table gives no rows.
    """
    rows = stage(perplexity(docs, labels, label=label), f"{label}-rows").withColumn("nats", -F.col("logp") / F.nullif(F.col("n_symbols"), F.lit(0).cast("long")))
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    trusted = rows.select("doc_id", "lang", "nats", "n_symbols").where("nats IS NOT NULL").join(good, "doc_id", "left_semi")
    slack = SLACK / F.sqrt(F.greatest("n_symbols", F.lit(1)))
    over = F.col("nats") - slack
    figure = F.percentile_approx(over, QUANTILE, 10_000).alias("limit")
    by_lang = trusted.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("docs"), figure).where(F.col("docs") >= LEAST_DOCS)
    whole = trusted.agg(figure).first()["limit"]
    limits = stage(by_lang.select("_lang", "limit"), f"{label}-limits")
    limit = F.coalesce("limit", F.lit(whole).cast("double")) + MARGIN + slack
    told = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumn("limit", limit)
    kept = F.coalesce(F.col("nats") <= F.col("limit"), F.lit(True))
    return told.select("doc_id", "lang", "n_words", F.exp("nats").alias("perplexity"), F.when(F.col("nats").isNotNull(), F.exp("limit")).alias("threshold"), kept.alias("kept"))
