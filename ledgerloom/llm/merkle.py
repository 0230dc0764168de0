"""Merkle manifest of a document table as a content-addressed DAG, and proofs by descent from its root.

The manifest is a store of records ``digest, children``, one for each distinct inner node, kept by height.  A leaf is the
digest of a document's fields.  The leaves of a group (a language) in the order of their key form a tree of runs of FAN
nodes, the last run shorter; the trees' roots, in the order of their groups, form one more.

A proof is asked for by group and rank.  A rank written in base FAN is the way down: a request enters at the root, its
leading digit selects a child there, the children not selected are the siblings of that step, and so on to the leaf.
Requests that share leading digits walk as one, so at each height there is one row for each node on some way.  The steps
are collected from the top and turned round for the proof, which is read from the leaf up.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.ids import global_rank, occurrence
from ledgerloom.session import stage

FAN, DIGIT_BITS = 8, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPERED = 3  # documents whose number by crc32 is divisible by it are tampered with
TOP = ""  # the group of the tree of subroots


def field(value: Column) -> Column:
    """A field in a leaf: ``-`` for null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    told = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(told, F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(of: dict[str, Column]) -> Column:
    return digest(*(field(of[name]) for name in FIELDS))


@dataclass(frozen=True)
class Tree:
    """``records[h]`` has ``digest, children`` of all distinct nodes of height h + 1; ``roots`` has ``g, n, height, digest``."""

    records: list[DataFrame]
    roots: DataFrame


@dataclass(frozen=True)
class Manifest:
    """``leaves`` has ``g, rank, leaf`` and what came along; ``top`` is the tree of the roots of the group trees ``below``."""

    leaves: DataFrame
    below: Tree
    top: Tree


def grown(nodes: DataFrame, most: int, label: str) -> Tree:
    """Trees over ``g, rank, n, digest``: the nodes of each group by rank from 0, n the group's size, at most ``most``.

    Each height is made from the one below by one aggregate, whose map side joins most runs as the leaves are stored in
    order, and is written, so a lost executor costs no more than its part of one height.
    """
    records, roots, height = [], [nodes.where("n = 1").select("g", "n", F.lit(0).alias("height"), "digest")], 0
    size = F.col("n")
    while most > 1:
        height += 1
        run = F.shiftright("rank", DIGIT_BITS)
        members = F.sort_array(F.collect_list(F.struct("rank", "digest"))).getField("digest")
        runs = nodes.where("n > 1").groupBy("g", run.alias("run"), F.shiftright(size + (FAN - 1), DIGIT_BITS).alias("n")).agg(members.alias("children"))
        made = runs.select("g", F.col("run").alias("rank"), "n", digest(F.array_join("children", "")).alias("digest"), "children")
        nodes = stage(made, f"{label}-{height}")
        records.append(nodes.groupBy("digest").agg(F.first("children").alias("children")))
        roots.append(nodes.where("n = 1").select("g", "n", F.lit(height).alias("height"), "digest"))
        most = -(-most // FAN)
    return Tree(records, stage(reduce(DataFrame.unionByName, roots).drop("n"), f"{label}-roots"))


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", **along: Column) -> Manifest | None:
    """The manifest of all documents, None for an empty table.

    Documents of a group ascend by ``key``, nulls first, then by leaf.  A null group is a group of its own, before all others.
    Rows that repeat a document are leaves of their own with equal digests, and nodes that are equal share one record.
    Other columns, whatever their names, play no part; ``along`` is kept beside each leaf.
    """
    made = {n: c for n, c in along.items()}
    told = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))  # keeps the order, null first
    leaves = stage(docs.select(told.alias("g"), F.col(f"`{key}`").alias("key"), leaf({n: F.col(f"`{n}`") for n in FIELDS}).alias("leaf"), *(c.alias(n) for n, c in made.items())), "merkle-leaves")
    sizes = stage(leaves.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "merkle-sizes")
    most, groups = sizes.agg(F.max("n"), F.count(F.lit(1))).first()
    if not groups:
        return None
    ranked = occurrence(leaves, F.col("g"), [F.col("key"), F.col("leaf")], "place", "merkle-order")
    ranked = ranked.withColumn("rank", F.col("place") - 1).drop("place")
    below = grown(ranked.join(sizes, "g").select("g", "rank", "n", F.col("leaf").alias("digest")), most, "merkle-tree")
    numbered = global_rank(below.roots, [F.col("g")], "place", "merkle-groups")
    subroots = numbered.select(F.lit(TOP).alias("g"), (F.col("place") - 1).alias("rank"), F.lit(groups).cast("long").alias("n"), "digest", F.col("g").alias("of"), "height")
    subroots = stage(subroots, "merkle-subroots")
    top = grown(subroots.select("g", "rank", "n", "digest"), groups, "merkle-top")
    return Manifest(ranked, Tree(below.records, subroots.select(F.col("of").alias("g"), F.col("rank").alias("number"), "height", "digest")), top)


PATH = "array<struct<before:string,after:string>>"


def _step(children: Column, digit: Column, path: Column) -> Column:
    """The way with one more step: the children on either side of the one that the digit selects."""
    one = F.struct(F.array_join(F.slice(children, 1, digit), "").alias("before"), F.array_join(F.slice(children, digit + 2, FAN), "").alias("after"))
    return F.concat(path, F.array(one))


def _selected(at: DataFrame, records: DataFrame, asked: DataFrame) -> DataFrame:
    """One height further down: of the nodes ``g, rank, digest, path`` the children whose ranks are asked for.

    ``asked`` has ``g, child`` and columns of its own, one row or more for each child on a way.  Keys are nodes, of which
    each has at most FAN children, so no key holds many rows.
    """
    nodes = at.join(records, "digest").drop("digest")
    ways = asked.withColumn("rank", F.shiftright("child", DIGIT_BITS)).withColumn("digit", F.col("child").bitwiseAND(F.lit(FAN - 1).cast("long")).cast("int"))
    found = nodes.join(ways, ["g", "rank"])
    others = [c for c in asked.columns if c not in ("g", "child")]
    return found.select("g", F.col("child").alias("rank"), F.element_at("children", F.col("digit") + 1).alias("digest"), _step(F.col("children"), F.col("digit"), F.col("path")).alias("path"), *others)


def _prefixes(asked: DataFrame, heights: int) -> list[DataFrame]:
    """``g, child`` of the distinct leading digits of the ranks asked for, from those of height 1 up."""
    out = []
    for height in range(heights):
        run = F.shiftright("rank" if height == 0 else "child", DIGIT_BITS)
        asked = asked.groupBy("g", run.alias("child")).agg(F.lit(0).alias("_")).drop("_")
        if height:
            asked = stage(asked, "merkle-ways")
        out.append(asked)
    return out


def descended(tree: Tree, entries: DataFrame, asked: DataFrame) -> DataFrame:
    """``g, rank, digest, path`` and the columns of ``asked`` (``g, rank`` and more) for each leaf asked for.

    ``entries`` has ``g, height, digest, path``: where each group's tree is entered.  Trees of lower height wait their turn.
    """
    others = [c for c in asked.columns if c not in ("g", "rank")]
    enter = entries.withColumn("rank", F.lit(0).cast("long"))
    heights = len(tree.records)
    ways = _prefixes(asked.select("g", "rank"), heights)
    at = enter.where(F.col("height") == heights).select("g", "rank", "digest", "path")
    for height in range(heights, 1, -1):
        below = _selected(at, tree.records[height - 1], ways[height - 2])
        waiting = enter.where(F.col("height") == height - 1).select("g", "rank", "digest", "path")
        at = stage(below.unionByName(waiting), "merkle-down")
    alone = enter.where("height = 0").join(asked, ["g", "rank"]).select("g", "rank", "digest", "path", *others)
    if not heights:
        return alone
    last = asked.withColumnRenamed("rank", "child")
    return _selected(at, tree.records[0], last).unionByName(alone)


def proofs(of: Manifest, asked: DataFrame) -> DataFrame:
    """For each request (``g, rank`` and more columns): ``leaf, subroot, root`` and ``path``, the steps from the leaf up."""
    none = F.array().cast(PATH)
    start = of.top.roots.select("g", "height", "digest", none.alias("path"))
    groups = of.below.roots.select(F.lit(TOP).alias("g"), F.col("number").alias("rank"), F.col("g").alias("of"), F.col("height").alias("deep"))
    wanted = groups.join(asked.select(F.col("g").alias("of")).distinct(), "of", "left_semi")
    entered = stage(descended(of.top, start, wanted).select(F.col("of").alias("g"), F.col("deep").alias("height"), "digest", "path"), "merkle-entered")
    reached = descended(of.below, entered, asked)
    root = of.top.roots.first()["digest"]
    named = reached.join(entered.select("g", F.col("digest").alias("subroot")), "g")
    return named.withColumnsRenamed({"digest": "leaf"}).withColumns({"root": F.lit(root), "path": F.reverse("path")})


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the steps above it give."""
    return F.aggregate(path, leaf, lambda held, step: digest(step["before"], held, step["after"]))


def proof_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verified(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row.

    Documents whose crc32 (of the id in decimal) is divisible by TAMPERED have the letters A-Z of their text lower-cased
    before the proof is folded; a null id is never tampered with.  The tampered leaf goes beside the true one, so texts are
    read once.  An empty table has no rows.
    """
    of = {n: F.col(f"`{n}`") for n in FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    other = F.when(hit, leaf(of | {"text": F.translate("text", UPPER, LOWER)}))
    made = manifest(docs, tampered=other, doc_id=F.col("doc_id"))
    if made is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    told = proofs(made, made.leaves.select("g", "rank", "doc_id", "tampered"))
    again = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    out = told.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), again.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
