"""Writers. None overwrites what it was not asked to: the default is to leave existing output alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheafline.functions.text import Rule, fix_text
from sheafline.operators.parse import collect_papers
from sheafline.sources.texts import read_files


def write_new(df: DataFrame, existing: DataFrame | None, key: Sequence[str], path: str, force: bool = False) -> DataFrame:
    """Append the rows whose key is not in the output yet (all, when forced) by year and region; what was written."""
    todo = df if existing is None or force else df.join(existing.select(*key).distinct(), list(key), "left_anti")
    todo.write.mode("overwrite" if force else "append").partitionBy("year", "region").parquet(path)
    return todo


def write_archive(items: DataFrame, id: str, path: str) -> None:
    """Parsed items as nested JSON, one row per paper."""
    collect_papers(items, id).write.mode("errorifexists").json(path)


def manifest(images: DataFrame, key: Sequence[str], content: str = "content") -> DataFrame:
    """(key, count, images): one nested row per source with size and SHA-256 of each image."""
    each = F.struct("file", "page", F.length(content).alias("bytes"), F.sha2(content, 256).alias("sha256"))
    return images.groupBy(*key).agg(F.count(F.lit(1)).alias("count"), F.array_sort(F.collect_list(each)).alias("images"))


def markdown_table(df: DataFrame, columns: Sequence[str], group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(group, table): the rows of each group as a pipe table in order."""
    cell = lambda c: F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"\|", "\\\\|")
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *(cell(c) for c in columns)), F.lit(" |"))
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns)
    rows = F.transform(F.array_sort(F.collect_list(F.struct(*order, row.alias("_row")))), lambda x: x["_row"])
    return df.groupBy(*group).agg(F.concat(F.lit(head + "\n"), F.array_join(rows, "\n")).alias("table"))


def rewrite(df: DataFrame, path: str, write: bool = False) -> DataFrame:
    """Rows that a rewrite changed (column ``changes`` not empty); the whole set is written only on demand."""
    if write:
        df.drop("changes").write.mode("overwrite").parquet(path)
    return df.where(F.size("changes") > 0)


def report(findings: DataFrame) -> tuple[DataFrame, int]:
    """Findings in order, and the exit code: 1 if any is an error."""
    code = findings.agg(F.coalesce(F.max((F.col("level") == "error").cast("int")), F.lit(0))).first()[0]
    return findings.orderBy("level", "check", "year", "region", "number", "line"), code


def exit_code(level: Column) -> Column:
    return F.coalesce(F.max((level == "error").cast("int")), F.lit(0))


def write_material(sources: DataFrame, stored: DataFrame, path: str, force: bool = False) -> DataFrame:
    """(folder, state): merged texts are written for folders that have none, or for all when forced.

    ``sources`` has folder, text (the merged text), hash (of its sources) and complete (whether every
    source is there); ``stored`` has folder and hash of what is written. ``state`` is built, skipped,
    drift (other sources than the written text was made of) or incomplete (never built over a text that exists).
    """
    both = sources.join(stored.select("folder", F.col("hash").alias("old"), F.lit(True).alias("there")), "folder", "left")
    there = F.coalesce("there", F.lit(False))
    state = F.when(F.col("text").isNull() | ~F.col("complete") & there & ~F.lit(force), "incomplete").when(there & ~F.lit(force), F.when(F.col("old") != F.col("hash"), "drift").otherwise("skipped")).otherwise("built")
    planned = both.withColumn("state", state)
    planned.where("state = 'built'").select("folder", "text", "hash").write.mode("append").parquet(path)
    return planned.select("folder", "state")


def write_ledger(merged: DataFrame, path: str, write: bool = False) -> DataFrame:
    """The rows that reviews change; the whole new ledger is written only on demand, to a new snapshot."""
    if write:
        merged.drop("change").write.mode("errorifexists").parquet(path)
    return merged.where("change <> 'kept'")


def write_matches(matches: DataFrame, path: str) -> None:
    """Located figures as JSON, scores with three places."""
    scores = {c: F.round(c, 3) for c in ("crop_score", "score") if c in matches.columns}
    matches.withColumns(scores).write.mode("errorifexists").json(path)


def recipe_drafts(parts: DataFrame, base: str, file: str = "file") -> DataFrame:
    """(file, recipe): a draft recipe, as JSON, for each picture of two panels or more; targets are
    ``<base>/<stem><letter>.png`` in the order of the panels, to be renamed by hand.

    ``parts`` has the file and the boxes of its panels.
    """
    stem = F.regexp_replace(F.element_at(F.split(file, "/"), -1), r"\.[^.]*$", "")
    boxes = F.array_sort(F.collect_list(F.struct("y0", "x0", "x1", "y1")))
    held = parts.groupBy(file).agg(boxes.alias("boxes")).where("size(boxes) > 1")
    crop = lambda b, i: F.struct(F.array(b["x0"], b["y0"], b["x1"] - b["x0"], b["y1"] - b["y0"]).alias("rect"), F.concat(F.lit(f"{base}/"), stem, F.chr((i + 97).cast("long")), F.lit(".png")).alias("target"))
    entry = F.struct(F.array(F.struct(F.col(file).alias("source"), F.transform("boxes", crop).alias("crops"))).alias("entries"))
    return held.select(file, F.to_json(entry).alias("recipe"))


def fix_files(spark: SparkSession, root: str, out: str | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """(path, changes) of the sources under a folder that the text rules change; the fixed texts are written only
    where ``out`` is given, never over the sources."""
    files = read_files(spark, root, (".tex",))
    fixed = fix_text(files.select("path", "text"), "text", rules)
    if out:
        fixed.where(F.size("changes") > 0).select("path", "text").write.mode("errorifexists").parquet(out)
    return fixed.where(F.size("changes") > 0).select("path", "changes")
