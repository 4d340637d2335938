"""Joins between datasets of the archive. Every match key is an equality that Spark can hash or sort;
a side is broadcast only where its size is bounded, and otherwise left to the planner."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline.functions.geometry import overlaps
from sheafline.functions.text import squeeze


def compare(left: DataFrame, right: DataFrame, key: Sequence[str], fields: Sequence[str], normalise=squeeze) -> DataFrame:
    """(key, field, left, right): full outer comparison of two sides with unique keys.

    A key on one side alone gives one row with field ``missing_left`` or ``missing_right``; a key
    on both gives a row for each field whose normalised values differ.
    """
    a = left.select(*key, F.struct(*(F.col(f).cast("string").alias(f) for f in fields)).alias("a"), F.lit(True).alias("in_a"))
    b = right.select(*key, F.struct(*(F.col(f).cast("string").alias(f) for f in fields)).alias("b"), F.lit(True).alias("in_b"))
    both = a.join(b, list(key), "full_outer")
    missing = F.when(F.col("in_b").isNull(), "missing_right").when(F.col("in_a").isNull(), "missing_left")
    one = F.array(F.struct(missing.alias("field"), F.lit(None).cast("string").alias("left"), F.lit(None).cast("string").alias("right")))
    all_ = F.array(*(F.struct(F.lit(f).alias("field"), normalise(F.col(f"a.{f}")).alias("left"), normalise(F.col(f"b.{f}")).alias("right")) for f in fields))
    rows = F.when(missing.isNotNull(), one).otherwise(F.filter(all_, lambda x: x["left"] != x["right"]))
    return both.select(*key, F.explode(rows).alias("x")).select(*key, "x.field", "x.left", "x.right")


def remap(items: DataFrame, numbers: DataFrame, key: Sequence[str] = ("year", "region")) -> DataFrame:
    """Items with ``source_number``: the i-th of the paper's list of source numbers, else their own.

    ``numbers`` has the key and ``sourceNumbers``, an array.
    """
    joined = items.join(numbers.select(*key, "sourceNumbers"), list(key), "left")
    own = F.try_element_at("sourceNumbers", F.greatest(F.col("number"), F.lit(1)).cast("int"))
    return joined.withColumn("source_number", F.when(F.col("number") >= 1, F.coalesce(own, "number")).otherwise(F.col("number"))).drop("sourceNumbers")


def missing(refs: DataFrame, defs: DataFrame, on: Sequence[str], broadcast: bool = False) -> DataFrame:
    """References without a definition. ``broadcast`` is for definitions of a fixed size, such as a dictionary."""
    defs = defs.select(*on).distinct()
    return refs.join(F.broadcast(defs) if broadcast else defs, list(on), "left_anti")


def agree_with_set(items: DataFrame, answers: DataFrame, key: Sequence[str], value: str, other: str) -> DataFrame:
    """Items whose value is not in the set of the other side's values under the same key; keys without a set are left out."""
    sets = answers.groupBy(*key).agg(F.collect_set(other).alias("allowed"))
    return items.join(sets, list(key)).where(~F.array_contains("allowed", F.col(value)))


def agree_with_others(items: DataFrame, key: Sequence[str], id: str, value: str) -> DataFrame:
    """(id, value, finding): items whose value no other id of the key gives: ``differs``, or ``no other side``
    where the key has no other id.

    A value that one id alone gives needs no join back to it, and a key's values are few.
    """
    counts = items.select(*key, id, value).distinct().groupBy(*key, value).agg(F.count(F.lit(1)).alias("same"), F.min(id).alias("lo"), F.max(id).alias("hi"))
    w = Window.partitionBy(*key)
    whole = counts.withColumn("alone", F.min("lo").over(w) == F.max("hi").over(w)).where("same = 1")
    return whole.select(F.col("lo").alias(id), value, F.when(F.col("alone"), "no other side").otherwise("differs").alias("finding"))


def resolve_files(refs: DataFrame, files: DataFrame, path: str = "path", extensions: Sequence[str] = ("svg", "png", "jpg", "jpeg", "pdf")) -> DataFrame:
    """References (``path``) that neither exist as they are nor with one of the extensions."""
    stem = F.regexp_replace(path, r"\.[^./]*$", "")
    tries = F.array_distinct(F.concat(F.array(F.col(path)), F.array(*(F.concat(stem, F.lit(f".{e}")) for e in extensions))))
    wide = refs.select(path).distinct().withColumn("candidate", F.explode(tries))
    hit = wide.join(files.select(F.col("path").alias("candidate")).distinct(), "candidate", "left_semi").select(path).distinct()
    return refs.join(hit, path, "left_anti")


def dead_links(docs: DataFrame, files: DataFrame) -> DataFrame:
    """(path, link): links of documents to files that are not there, read relative to the document.

    ``docs`` has path and links, an array; addresses, anchors and mail links are left out.
    """
    each_ = docs.select("path", F.explode("links").alias("link")).where(~F.col("link").rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:|#|//)"))
    bare = F.regexp_replace("link", r"[#?].*$", "")
    start = F.concat(F.regexp_replace("path", r"[^/]*$", ""), bare)
    parts = F.filter(F.split(F.when(bare.startswith("/"), bare).otherwise(start), "/"), lambda p: ~p.isin("", "."))
    up = F.aggregate(parts, F.array().cast("array<string>"), lambda a, p: F.when(p == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(p))))
    whole = each_.withColumn("goal", F.concat(F.when(start.startswith("/"), F.lit("/")).otherwise(F.lit("")), F.array_join(up, "/")))
    there = files.select(F.col("path").alias("goal")).distinct()
    folders = there.select(F.regexp_replace("goal", r"/[^/]*$", "").alias("goal")).distinct()
    return whole.join(there.unionByName(folders).distinct(), "goal", "left_anti").select("path", "link")


def complete(manifests: DataFrame, files: DataFrame) -> DataFrame:
    """(source, listed, missing): how many files each manifest lists and how many of them are not there.

    ``manifests`` has source and images, an array of paths; one that lists none is complete.
    """
    wide = manifests.select("source", F.explode_outer("images").alias("path"))
    hit = wide.join(files.select("path", F.lit(1).alias("there")).distinct(), "path", "left")
    return hit.groupBy("source").agg(F.count("path").alias("listed"), F.count_if(F.col("path").isNotNull() & F.col("there").isNull()).alias("missing"))


def crops_of_documents(docs: DataFrame, crops: DataFrame) -> DataFrame:
    """(path, source, targets): the crops that a document shows, by source picture, in order of their names.

    ``docs`` has path and images, an array of stems; ``crops`` has source and target.
    """
    stem = F.regexp_replace(F.element_at(F.split("target", "/"), -1), r"\.[^.]*$", "")
    used = docs.select("path", F.explode(F.array_distinct("images")).alias("stem"))
    both = used.join(crops.select("source", "target", stem.alias("stem")), "stem")
    return both.groupBy("path", "source").agg(F.array_sort(F.collect_set("target")).alias("targets"))


def first_hit(keys: DataFrame, candidates: DataFrame, key: str, value: str, priority: str) -> DataFrame:
    """(key, value): the candidate of least priority, ties by value; null where there is none."""
    best = candidates.groupBy(key).agg(F.min_by(value, F.struct(priority, value)).alias(value))
    return keys.join(best, key, "left")


def longest_prefix(folders: DataFrame, files: DataFrame) -> DataFrame:
    """(folder, name, path): for each folder the file of that name whose parent is the longest prefix of the folder;
    else the only file of that name.

    ``folders`` has folder and name, ``files`` has path and name. The match is on the name; prefixes
    are compared inside it.
    """
    f = files.withColumn("parent", F.regexp_replace("path", r"/[^/]*$", ""))
    both = folders.join(f, "name")
    under = (F.col("folder") == F.col("parent")) | F.startswith("folder", F.concat("parent", F.lit("/")))
    best = both.groupBy("folder", "name").agg(F.max_by("path", F.when(under, F.struct(F.length("parent"), "path"))).alias("prefix"), F.count(F.lit(1)).alias("n"), F.min("path").alias("only"))
    return folders.join(best, ["folder", "name"], "left").select("folder", "name", F.coalesce("prefix", F.when(F.col("n") == 1, F.col("only"))).alias("path"))


def overlapping(boxes: DataFrame, group: Sequence[str], id: str) -> DataFrame:
    """(group, a, b): pairs of boxes of one group, a before b, that share an area.

    Boxes have x0, y0, x1, y1. A box lies in at most two cells of a grid as coarse as its own width
    (a power of two); it looks for partners there and in the coarser grids that its group has, of which
    there are few. So neither a large group nor one wide box in it pairs all with all.
    """
    cols = ("x0", "y0", "x1", "y1")
    level = F.ceil(F.log2(F.greatest(F.col("x1") - F.col("x0"), F.lit(1e-9)))).cast("int")
    own = boxes.select(*group, F.col(id).alias("id"), *cols, level.alias("level"))
    levels = own.groupBy(*group).agg(F.collect_set("level").alias("levels"))
    cells = lambda at: F.sequence(F.floor(F.col("x0") / F.pow(F.lit(2.0), F.col(at))), F.floor(F.col("x1") / F.pow(F.lit(2.0), F.col(at))))
    seeking = own.join(levels, list(group)).withColumn("at", F.explode(F.filter("levels", lambda x: x >= F.col("level")))).drop("levels")
    a = seeking.withColumn("cell", F.explode(cells("at"))).select(*group, "at", "cell", F.col("id").alias("a"), F.col("level").alias("a_level"), *(F.col(c).alias(f"a_{c}") for c in cols))
    b = own.withColumn("cell", F.explode(cells("level"))).select(*group, F.col("level").alias("at"), "cell", F.col("id").alias("b"), *(F.col(c).alias(f"b_{c}") for c in cols))
    hit = overlaps({c: F.col(f"a_{c}") for c in cols}, {c: F.col(f"b_{c}") for c in cols})
    once = (F.col("a_level") < F.col("at")) | (F.col("a") < F.col("b"))
    found = a.join(b, [*group, "at", "cell"]).where((F.col("a") != F.col("b")) & once & hit)
    return found.select(*group, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def zip_by_position(left: DataFrame, right: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, pos, a, b) of two lists under one key; lists of unlike length give no rows."""
    both = left.join(right, key).where(F.size(a) == F.size(b))
    return both.select(key, F.posexplode(F.arrays_zip(F.col(a).alias("l"), F.col(b).alias("r"))).alias("pos", "x")).select(key, "pos", F.col("x.l").alias(a), F.col("x.r").alias(b))


def _unit(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    m = np.array(table.column("vec").to_pylist(), float).reshape(table.num_rows, -1)
    m = m - m.mean(axis=1, keepdims=True)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return table.column("id").to_numpy(), np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _product(left: pa.Table, right: pa.Table) -> pa.Table:
    """The best of one block of the pool for each query of one block."""
    names = ["query_id", "match_id", "score"]
    if not left.num_rows or not right.num_rows:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
    order = np.argsort(right.column("id").to_numpy(), kind="stable")  # the first of equals is the smaller id
    (qi, a), (pi, b) = _unit(left), _unit(right.take(pa.array(order)))
    score = np.round(a @ b.T, 6) + 0.0
    score[qi[:, None] == pi[None]] = -np.inf
    best = score.argmax(axis=1)
    top = score[np.arange(len(qi)), best]
    keep = np.isfinite(top)
    return pa.table([pa.array(qi[keep]), pa.array(pi[best][keep]), pa.array(top[keep])], names=names)


def nearest(queries: DataFrame, pool: DataFrame, scope: Sequence[str] = (), block: int = 2048) -> DataFrame:
    """(query_id, match_id, score): the most alike vector of the same scope, by centred cosine.

    ``queries`` and ``pool`` have id, vec and the scope columns; a query never matches its own id.
    Scores have six places; ties go to the smaller id; a vector without variance scores 0.
    Both sides of a scope are cut into blocks of about ``block`` rows by the scope's own sizes; each
    pair of blocks is one task's matrix product and keeps one best per query.
    """
    slim = lambda df: df.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"), *(F.col(c).alias(c) for c in scope))
    q, p = (slim(x).withColumn("_all", F.lit(0)) for x in (queries, pool))
    scope = ("_all", *scope)
    parts = lambda df, name: df.groupBy(*scope).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))
    sizes = parts(q, "qn").join(parts(p, "pn"), list(scope))  # one row a scope
    own = lambda n: F.expr(f"cast(pmod(xxhash64(id), {n}) as int)")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = q.join(sizes, list(scope)).withColumn("qb", own("qn")).withColumn("pb", every("pn")).drop("qn", "pn")
    b = p.join(sizes, list(scope)).withColumn("pb", own("pn")).withColumn("qb", every("qn")).drop("qn", "pn")
    key = [*scope, "qb", "pb"]
    each = a.groupBy(*key).cogroup(b.groupBy(*key)).applyInArrow(_product, "query_id long, match_id long, score double")
    return each.groupBy("query_id").agg(F.max_by(F.struct("match_id", "score"), F.struct("score", -F.col("match_id"))).alias("m")).select("query_id", "m.match_id", "m.score")


def best_match(queries: DataFrame, pool: DataFrame, scope: Sequence[str], trust: float = 0.6, block: int = 2048) -> DataFrame:
    """(query_id, match_id, score, scoped): the most alike vector of the same scope; below ``trust`` the
    best of the whole pool. The whole-pool search runs for the remainder alone."""
    scoped = nearest(queries, pool, scope, block).where(F.col("score") >= trust).withColumn("scoped", F.lit(True))
    rest = queries.join(scoped.select(F.col("query_id").alias("id")), "id", "left_anti")
    return scoped.unionByName(nearest(rest, pool, (), block).withColumn("scoped", F.lit(False)))


def locate_figures(old: DataFrame, crops: DataFrame, pictures: DataFrame, trust: float = 0.6) -> DataFrame:
    """(id, crop, crop_score, source, page, picture, kind, score): where each old figure comes from.

    First the most alike recognised crop gives source and page; then the most alike picture there, whole
    or a panel of it; below ``trust`` the most alike whole picture anywhere, if it is better.
    ``old`` has id and vec; ``crops`` adds source and page; ``pictures`` adds kind (``whole`` or a panel's name).
    """
    top = nearest(old, crops).select(F.col("query_id").alias("id"), F.col("match_id").alias("crop"), F.col("score").alias("crop_score"))
    placed = top.join(crops.select(F.col("id").alias("crop"), "source", "page"), "crop")
    queries = old.select("id", "vec").join(placed.select("id", "source", "page"), "id")
    here = nearest(queries, pictures, ("source", "page")).select(F.col("query_id").alias("id"), F.struct(F.col("score"), F.col("match_id").alias("picture"), F.lit(False).alias("anywhere")).alias("best"))
    weak = old.select("id", "vec").join(here.where(F.col("best.score") >= trust).select("id"), "id", "left_anti")
    wide = nearest(weak, pictures.where("kind = 'whole'")).select(F.col("query_id").alias("id"), F.struct(F.col("score"), F.col("match_id").alias("picture"), F.lit(True).alias("anywhere")).alias("other"))
    both = placed.join(here, "id", "full_outer").join(wide, "id", "full_outer")
    best = F.when(F.col("best").isNull() | (F.col("other.score") > F.col("best.score")), F.col("other")).otherwise(F.col("best"))
    kinds = pictures.select(F.col("id").alias("picture"), "kind")
    out = both.select("id", "crop", "crop_score", "source", "page", best.alias("m")).select("id", "crop", "crop_score", "source", "page", "m.picture", "m.score", "m.anywhere")
    return out.join(kinds, "picture", "left").select("id", "crop", "crop_score", "source", "page", "picture", F.concat("kind", F.when(F.col("anywhere"), "*").otherwise("")).alias("kind"), "score")


def same_text_label(left: DataFrame, right: DataFrame, label: str, value: str) -> DataFrame:
    """(label, left, right): labels on both sides, compared without white space, whose values differ so too."""
    bare = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"[\s　]+", "")
    a = left.select(bare(label).alias("label"), bare(value).alias("left"))
    b = right.select(bare(label).alias("label"), bare(value).alias("right"))
    return a.join(b, "label").where(F.col("left") != F.col("right"))


def with_default(facts: DataFrame, other: DataFrame, key: Sequence[str], field: str, default: Column) -> DataFrame:
    """Facts with a field of the other side, or a default where that has none or only blanks."""
    side = other.select(*key, F.nullif(F.trim(field), F.lit("")).alias("_own"))
    return facts.join(side, list(key), "left").withColumn(field, F.coalesce("_own", default)).drop("_own")
