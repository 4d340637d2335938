"""Readers: files and raw texts to tables of documents, lines, table rows and key-value headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from sheafline import schema

#: Fixed value: a path component that marks stand-alone drawings, which are no papers.
DRAWINGS = "TikZ"
EXTENSIONS = (".tex", ".sty", ".cls", ".md")


def read_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = (".tex",), skip: str | None = DRAWINGS) -> DataFrame:
    """(path, text) of every file below a folder, read whole and with plain line ends.

    Files below a component ``skip`` are left out; a folder without any file gives no rows.
    """
    glob = "*{" + ",".join(extensions) + "}"
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(folder, wholetext=True)
    df = df.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", r"\r\n?", "\n").alias("text"))
    return df if skip is None else df.where(~F.array_contains(F.split("path", "/"), skip))


def read_named(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, text) of files given by name: nothing is skipped, a name given twice is read once."""
    df = spark.read.text(list(dict.fromkeys(paths)), wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", r"\r\n?", "\n").alias("text"))


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, name, stem, extension, length, modified) of every file that is not empty, without its content."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return df.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("extension"), "length", F.col("modificationTime").alias("modified"))


def parents(files: DataFrame, *patterns: str) -> DataFrame:
    """(folder): distinct parents of the files whose path matches any pattern."""
    parts = [files.where(F.col("path").rlike(p)) for p in patterns] or [files]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.regexp_replace("path", r"/[^/]*$", "").alias("folder")).distinct()


def markdown_roots(files: DataFrame, root: str, folders: tuple[str, ...] = (), skip: tuple[str, ...] = (".git", "build"), generated: tuple[str, ...] = ()) -> DataFrame:
    """Markdown files: those right under the root, and all below the given folders of it; no generated ones."""
    rel = F.regexp_replace("path", "^(?:file:/*)?/?" + root.strip("/") + "/", "")
    kept = files.where(F.col("extension") == "md").withColumn("rel", rel).where(~F.col("name").isin(*generated) if generated else F.lit(True))
    wanted = ~F.col("rel").contains("/")
    for f in folders:
        wanted = wanted | F.col("rel").startswith(f.strip("/") + "/")
    for s in skip:
        wanted = wanted & ~F.array_contains(F.split("rel", "/"), s)
    return kept.where(wanted).drop("rel")


def sibling_logs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, text) of compile logs: those named, and for a source those in its folder; each once."""
    wanted = [p for p in paths if not p.endswith(".tex")] + [p.rpartition("/")[0] + "/*.log" for p in paths if p.endswith(".tex")]
    return read_named(spark, wanted).dropDuplicates(["path"])


def paper_facts(papers: DataFrame, files: DataFrame) -> DataFrame:
    """(year, region, path, questions, figs, student, teacher, placeholder) of paper folders.

    ``papers`` has path and text, ``files`` is a listing. The main source of a folder is the one named
    like it, else the first by name.
    """
    folder, name = F.regexp_replace("path", r"/[^/]*$", ""), F.regexp_extract("path", r"([^/]*)\.tex$", 1)
    own = papers.select("path", "text", folder.alias("folder"), *path_key(F.col("path")), name.alias("name")).where("year is not null")
    main = own.groupBy("folder", "year", "region").agg(F.min_by(F.struct("path", "text"), F.struct((F.col("name") != F.col("region")).cast("int"), "name")).alias("m"))
    parent = F.regexp_replace("path", r"/[^/]*$", "")
    listed = files.select(F.regexp_replace(parent, r"/figs$", "").alias("folder"), (F.element_at(F.split(parent, "/"), -1) == "figs").cast("int").alias("fig"), F.col("name").contains("学生").cast("int").alias("s"), F.col("name").contains("教师").cast("int").alias("t"))
    sums = listed.groupBy("folder").agg(F.sum("fig").alias("figs"), F.max("s").alias("s"), F.max("t").alias("t"))
    text = F.col("m.text")
    out = main.join(sums, "folder", "left")
    return out.select("year", "region", "m.path", F.regexp_count(text, F.lit(r"(?m)^%%\s*number\s*[:：]")).cast("long").alias("questions"), F.coalesce("figs", F.lit(0)).alias("figs"), (F.coalesce("s", F.lit(0)) > 0).alias("student"), (F.coalesce("t", F.lit(0)) > 0).alias("teacher"), F.regexp_count(text, F.lit("本题原卷及材料中未提供详解")).cast("long").alias("placeholder"))


def read_recipes(df: DataFrame, text: str = "text") -> DataFrame:
    """(source, pos, x0, y0, x1, y1, target, trims, relabels, valid) of crop recipe texts, one row per crop.

    ``trim`` may be a boolean or settings, ``erase_labels`` a boolean or a name: both come out as whether
    they are asked for. A text that is no JSON, or a rectangle without four numbers, gives ``valid`` false.
    """
    v = F.try_parse_json(F.col(text))
    asked = lambda x: F.coalesce(F.try_variant_get(x, "$", "boolean"), F.schema_of_variant(x).rlike("OBJECT|STRING"), F.lit(False))
    entries = df.select(F.explode_outer(F.try_variant_get(v, "$.entries", "array<variant>")).alias("e"), v.isNotNull().alias("json"))
    get = lambda k, kind: F.try_variant_get(F.col("e"), k, kind)
    crops = entries.select(get("$.source", "string").alias("source"), asked(get("$.trim", "variant")).alias("trims"), asked(get("$.erase_labels", "variant")).alias("relabels"), F.posexplode_outer(get("$.crops", "array<variant>")).alias("pos", "c"), "json")
    rect = F.try_variant_get("c", "$.rect", "array<long>")
    return crops.select("source", "pos", *(F.get(rect, i).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))), F.try_variant_get("c", "$.target", "string").alias("target"), "trims", "relabels", (F.col("json") & (F.coalesce(F.size(rect), F.lit(0)) == 4)).alias("valid"))


def read_registry(df: DataFrame, text: str = "text") -> DataFrame:
    """(tikz, original, declared, note) of redraw registry texts; an explicit null original is declared, a missing one is not."""
    v = F.try_parse_json(F.col(text))
    entries = df.select(F.explode(F.try_variant_get(v, "$.entries", "array<variant>")).alias("e"))
    return entries.select(*(F.try_variant_get("e", f"$.{n}", "string").alias(n) for n in ("tikz", "original")), F.try_variant_get("e", "$.original", "variant").isNotNull().alias("declared"), F.try_variant_get("e", "$.note", "string").alias("note"))


def path_key(path: Column) -> list[Column]:
    """Year and region from the last ``<year>/<region>`` of a path."""
    return [F.nullif(F.regexp_extract(path, r"((?:19|20)[0-9]{2}[^/]*)/([^/]+)(?:/[^/]*)?$", i), F.lit("")).alias(n) for i, n in ((1, "year"), (2, "region"))]


def read_papers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, year, region, pos, and the fields) of the items of paper JSON files; broken files give a null item."""
    raw = spark.read.schema(T.StructType([*schema.PAPER_JSON.fields, T.StructField("_corrupt_record", T.StringType())])).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").json(paths)
    raw = raw.withColumn("path", F.col("_metadata.file_path"))
    rows = raw.select("path", *path_key(F.col("path")), F.posexplode_outer("items").alias("pos", "item"), F.col("_corrupt_record").isNotNull().alias("broken"))
    return rows.select("path", "year", "region", "pos", "broken", "item.*")


def read_reviews(df: DataFrame, text: str = "text") -> DataFrame:
    """(year, region, number, category, problem, action, status) of review JSON texts.

    Three shapes are read: a bundle with ``entries``, a list of bundles, and a list of entries;
    an entry takes year and region from its bundle where it has none of its own.
    """
    v = F.try_parse_json(F.col(text))
    get = lambda x, path, kind="string": F.try_variant_get(x, path, kind)
    tops = df.select(F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.array(v)).alias("tops")).select(F.explode("tops").alias("top"))
    inner = F.try_variant_get(F.col("top"), "$.entries", "array<variant>")
    each = tops.select("top", F.explode(F.coalesce(inner, F.array(F.col("top")))).alias("e"))
    names = ("category", "problem", "action", "status")
    number = F.coalesce(get(F.col("e"), "$.number"), get(F.col("e"), "$.question"))
    return each.select(*(F.coalesce(get(F.col("e"), f"$.{n}"), get(F.col("top"), f"$.{n}")).alias(n) for n in ("year", "region")), number.alias("number"), *(get(F.col("e"), f"$.{n}").alias(n) for n in names)).where("problem is not null")


def read_manifest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, the manifest's fields, broken) of image manifests."""
    df = spark.read.schema(T.StructType([*schema.MANIFEST.fields, T.StructField("_corrupt_record", T.StringType())])).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").json(paths)
    return df.select(F.col("_metadata.file_path").alias("path"), *(f.name for f in schema.MANIFEST.fields), F.col("_corrupt_record").isNotNull().alias("broken"))


def lines(df: DataFrame, id: str, text: str = "text") -> DataFrame:
    """(id, line, value): the lines of each text, counted from 1."""
    return df.select(id, F.posexplode(F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n")).alias("line", "value")).withColumn("line", (F.col("line") + 1).cast("long"))


def headed_rows(df: DataFrame, id: str, text: str = "text", heading: str = r"^###\s*(.+?)\s*$", columns: int | None = None) -> DataFrame:
    """(id, line, heading, cells): rows of pipe tables under the last heading before them.

    Separator rows, and rows whose first cell is empty, are left out.
    """
    own = lines(df, id, text).withColumn("title", F.nullif(F.regexp_extract("value", heading, 1), F.lit("")))
    order = Window.partitionBy(id).orderBy("line")
    own = own.withColumn("heading", F.last("title", True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    cells = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    rows = own.where(F.trim("value").rlike(r"^\|.*\|$")).withColumn("cells", cells)
    rows = rows.where((F.col("cells")[0] != "") & ~F.col("cells")[0].rlike(r"^:?-+:?$"))
    if columns:
        rows = rows.where(F.size("cells") == columns)
    return rows.select(id, "line", "heading", "cells")


def first_table(df: DataFrame, id: str, text: str = "text", start: int = 1, end: int | None = None) -> DataFrame:
    """(id, line, cells): all rows, head and separator included, of the first pipe table of each text that begins
    within the lines ``start`` to ``end``; it ends where a line of the range is no row."""
    inside = F.col("line") >= start
    own = lines(df, id, text).where(inside if end is None else inside & (F.col("line") <= end)).where(F.trim("value").rlike(r"^\|.*\|$"))
    w = Window.partitionBy(id)
    at = own.withColumn("_k", F.col("line") - F.row_number().over(w.orderBy("line"))).withColumn("_first", F.min("_k").over(w))
    cells = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    return at.where("_k = _first").select(id, "line", cells.alias("cells"))


def progress_rows(df: DataFrame, id: str = "path", text: str = "text") -> DataFrame:
    """(year, region, questions, status, note, link) of a progress document's year tables."""
    rows = headed_rows(df, id, text, columns=5).where(~F.col("cells")[0].isin("地区", "region"))
    return rows.select(F.regexp_extract("heading", "([0-9]{4})", 1).alias("year"), *(F.col("cells")[i].alias(n) for i, n in enumerate(("region", "questions", "status", "note", "link"))))


def ledger_rows(df: DataFrame, id: str = "path", text: str = "text") -> DataFrame:
    """(section, region, question, category, problem, action, status) of any six-column table."""
    rows = headed_rows(df, id, text, heading=r"^#{2,3}\s*(.+?)\s*$", columns=6).where(~F.col("cells")[0].isin("地区", "region"))
    return rows.select(F.col("heading").alias("section"), *(F.col("cells")[i].alias(n) for i, n in enumerate(("region", "question", "category", "problem", "action", "status"))))


def bullets(df: DataFrame, id: str, text: str = "text") -> DataFrame:
    """(id, line, item): bullets with the indented lines that continue them."""
    own = lines(df, id, text).withColumn("starts", F.col("value").rlike(r"^[-*]\s+").cast("int"))
    order = Window.partitionBy(id).orderBy("line")
    own = own.withColumn("no", F.sum("starts").over(order)).withColumn("broken", F.sum((~F.col("value").rlike(r"^[-*]\s+|^\s+\S")).cast("int")).over(order))
    own = own.withColumn("at", F.first("broken").over(Window.partitionBy(id, "no").orderBy("line")))
    kept = own.where((F.col("no") > 0) & (F.col("broken") == F.col("at")))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line", F.trim(F.regexp_replace("value", r"^[-*]\s+", "")).alias("v")))), lambda x: x["v"])
    return kept.groupBy(id, "no").agg(F.min("line").alias("line"), F.array_join(parts, " ").alias("item")).drop("no")


def front_matter(text: Column) -> Column:
    """The key-value header between two lines of dashes, as a map; empty where there is none."""
    head = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---(?:\n|\z)", 1)
    pairs = F.filter(F.split(head, "\n"), lambda x: x.contains(":"))
    keys = F.array_distinct(F.transform(pairs, lambda x: F.trim(F.substring_index(x, ":", 1))))
    value = lambda x: F.regexp_replace(F.regexp_replace(x, r"^[^:]*:\s*", ""), r'^"|"?\s*$', "")
    # of a key that stands twice the last value counts
    last = lambda k: F.element_at(F.filter(pairs, lambda x: F.trim(F.substring_index(x, ":", 1)) == k), -1)
    return F.map_from_arrays(keys, F.transform(keys, lambda k: value(last(k))))


def body_of(text: Column) -> Column:
    """A text without its key-value header."""
    return F.regexp_replace(text, r"(?s)\A---\n.*?\n---(?:\n|\z)", "")


def image_listing(df: DataFrame, text: str = "text") -> DataFrame:
    """(page, num, type, width, height, x_ppi, y_ppi) of an image listing in aligned columns.

    Two header lines are skipped; rows of fewer than six columns or without numbers where
    numbers belong are dropped; resolutions are read from the end of the row.
    """
    rows = df.select(F.posexplode(F.split(text, r"\r?\n")).alias("i", "line")).where("i >= 2").select("i", F.split(F.trim("line"), r"\s+").alias("c")).where("size(c) >= 6")
    n = lambda i: F.try_element_at("c", F.lit(i)).try_cast("long")
    out = rows.select(n(1).alias("page"), n(2).alias("num"), F.col("c")[2].alias("type"), n(4).alias("width"), n(5).alias("height"), n(-4).alias("x_ppi"), n(-3).alias("y_ppi"))
    return out.where("page is not null and num is not null and width is not null and height is not null")


def macros(df: DataFrame, text: str = "text") -> DataFrame:
    r"""(macro): unit macros defined in a style file, one row each."""
    return df.select(F.explode(F.regexp_extract_all(text, F.lit(r"\\NewDocumentCommand\s+\\(U[A-Za-z]+)"), F.lit(1))).alias("macro")).distinct()


def missing_glyphs(df: DataFrame, id: str = "path", text: str = "text") -> DataFrame:
    """(id, glyph, font): characters a compile log reports as missing, distinct."""
    own = lines(df, id, text)
    a = own.select(id, F.regexp_extract("value", r"Missing character: There is no (\S+)(?: \([^)]*\))? in font ([^!]+)!", 1).alias("glyph"), F.regexp_extract("value", r"in font ([^!]+)!", 1).alias("font"))
    b = own.select(id, F.regexp_extract("value", r"Unicode character (\S+)(?: \([^)]*\))?", 1).alias("glyph"), F.lit("").alias("font")).where("glyph <> ''")
    return a.where("glyph <> ''").unionByName(b).distinct()


def page_images(files: DataFrame) -> DataFrame:
    """Image files with the page number that their name holds, where it holds one."""
    page = F.regexp_extract("stem", r"(?:page|p)[_-]?([0-9]+)", 1)
    return files.withColumn("page", F.nullif(page, F.lit("")).try_cast("long"))


def usable_images(images: DataFrame, least: int = 110) -> DataFrame:
    """Images without small ones and without header strips of scans."""
    return images.where((F.least("width", "height") >= least) & ~((F.col("width") >= 4000) & (F.col("height") < 260)))


def output_folders(pdfs: DataFrame) -> DataFrame:
    """(path, year, stem, target): one output folder per PDF named ``<..>_<region>``: the region, or the
    whole stem where a year has the region more than once or is no four digits. Other names have none.

    ``pdfs`` has path, year and stem.
    """
    region = F.regexp_extract("stem", r"^[^_]*_(.*)$", 1)
    many = F.count(F.lit(1)).over(Window.partitionBy("year", region)) > 1
    whole = many | ~F.col("year").rlike(r"^[0-9]{4}$")
    return pdfs.where(F.col("stem").contains("_")).withColumn("target", F.concat_ws("/", "year", F.when(whole, F.col("stem")).otherwise(region)))
