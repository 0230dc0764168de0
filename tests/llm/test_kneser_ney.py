import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import zstandard

from ledgerloom.llm import kneser_ney as K

SCHEMA = "doc_id long, text string, lang string, gram string, block string"


class Plain:
    """The model by the book, for one language, on dictionaries."""

    def __init__(self, words):
        tables = {K.ORDER: Counter(g for w, n in words.items() for g in K.grams(w) for _ in range(n))}
        for n in range(K.ORDER - 1, 0, -1):
            tables[n] = Counter(g[1:] for g in tables[n + 1])
        self.tables, self.d = tables, {}
        for n, t in tables.items():
            k = [sum(c == i for c in t.values()) for i in range(5)]
            y = k[1] / max(k[1] + 2 * k[2], 1)
            self.d[n] = [max(min(i - (i + 1) * y * k[i + 1] / max(k[i], 1), i - 0.05), 0.05) if k[i] else 0.5 for i in (1, 2, 3)]
        self.total, self.mass = defaultdict(int), defaultdict(float)
        for n, t in tables.items():
            for g, c in t.items():
                self.total[n, g[:-1]] += c
                self.mass[n, g[:-1]] += self.d[n][min(c, 3) - 1]

    def p(self, g):
        n = len(g)
        below = 1 / (len(self.tables[1]) + 1) if n == 1 else self.p(g[1:])
        if (n, g[:-1]) not in self.total:
            return below
        c = self.tables[n][g]
        own = (c - self.d[n][min(c, 3) - 1] if c else 0) + self.mass[n, g[:-1]] * below
        return own / self.total[n, g[:-1]]


def test_like_the_book(spark):
    rng = random.Random(1)
    said = lambda n: " ".join("".join(rng.choice(["an", "er", "ti", "o", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(i, said(rng.randint(1, 40)), "en" if i % 3 else "fr", "", "") for i in range(40)]
    rows += [(90, "x#y neverseen", "en", "", ""), (91, None, "en", "", ""), (92, " ", "fr", "", ""), (93, "ti", "unknown", "", ""), (None, "anti", "en", "", ""), (1, rows[1][1], "en", "", "")]
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(40)] + [(None, 1, 0), (91, 1, 0)], "doc_id long, quality int, toxic int")
    got = K.perplexity(spark.createDataFrame(rows, SCHEMA).repartition(3), labels).collect()
    assert len(got) == len(rows)
    models = {}
    for lang in ("en", "fr"):
        models[lang] = Plain(Counter(w for i, t, g, *_ in rows if g == lang and i is not None and i < 40 and i % 2 == 0 for w in t.split()))
    texts = {(i, g): t for i, t, g, *_ in rows}
    for r in got:
        words = (texts[r["doc_id"], r["lang"]] or "").split()
        if not words or r["lang"] == "unknown":
            assert r["logp"] is None
            continue
        want = sum(math.log(models[r["lang"]].p(g)) for w in words for g in K.grams(w))
        assert r["logp"] == pytest.approx(want, rel=1e-5) and r["n_symbols"] == sum(len(w) + 1 for w in words)
    for model in models.values():
        chars = [*model.tables[1], "中"]
        assert sum(model.p("ti"[-1:] + c) for c in chars) == pytest.approx(1)


def test_shards_agree_with_spark(spark):
    rows = [("   a",), ("né中x",), ("😀b c",), ("\x00\x01yz",)]
    got = spark.createDataFrame(rows, "gram string").select("gram", K._shard("gram", 7).alias("s")).collect()
    assert all(r["s"] == K.shard_of(r["gram"], 7) for r in got)


def test_verdicts(spark):
    rng = random.Random(2)
    said = lambda n: " ".join("".join(rng.choice(["an", "er", "ti", "lo"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(i, said(60), "en", "", "") for i in range(120)] + [(500, "#%$ zqx&& 99|| " * 20, "en", "", ""), (501, said(60), None, "", ""), (502, "", "en", "", ""), (503, said(9000), "en", "", "")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in K.judged(spark.createDataFrame(rows, SCHEMA), labels).collect()}
    assert len(got) == 124 and not got[500]["kept"] and all(r["kept"] for i, r in got.items() if i != 500)
    assert got[502]["perplexity"] is None and got[501]["perplexity"] is None


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert K.judged(spark.createDataFrame([], SCHEMA), none).count() == 0
    assert [r["kept"] for r in K.judged(spark.createDataFrame([(1, "a b", "en", "", "")], SCHEMA), none).collect()] == [True]


@pytest.mark.parametrize("table, split", [(K.TABLE, K.SPLIT_BYTES), (50, 7)])
def test_ngrams_of_a_block(monkeypatch, table, split):
    monkeypatch.setattr(K, "TABLE", table)
    monkeypatch.setattr(K, "SPLIT_BYTES", split)
    texts = {"en": ["ab ab\tabc\u00a0d  ", "", "\n 😀é 中" + "x" * 40, "ab"], "fr": ["ab zz"]}
    docs = [(lang, t) for lang, own in texts.items() for t in own]
    data = b"".join(len(t.encode()).to_bytes(8, "little") + t.encode() for _, t in docs)
    block = pa.table({
        "block": pa.array([3], pa.int64()), "docs": pa.array([[{"id": i, "lang": lang} for i, (lang, _) in enumerate(docs)]]),
        "texts": pa.array([zstandard.compress(data)], pa.binary()),
    })
    words = K.Words(block)
    assert words.sizes.tolist() == [len(t.encode().split()) for _, t in docs]
    got = K._listed(block, pa.table({"id": [0, 3, 4]}), 5)
    counts = Counter()
    for lang, own, n in zip(*(got.column(c).to_pylist() for c in ("lang", "grams", "counts"))):
        counts.update({(lang, g): k for g, k in zip(own, n)})
    want = Counter()
    for i, (lang, t) in enumerate(docs):
        for w in t.encode().split():
            for g in K.grams(w.decode()):
                want[lang, g] += i in (0, 3, 4)
    assert dict(counts) == dict(want)
