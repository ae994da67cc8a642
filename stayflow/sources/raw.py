"""Raw exports: one folder a site, a static CSV a site, one time-series CSV a stay.

<root>/UK_nn/static/andere_variablen_kds_patienten.csv      sep ;
<root>/UK_nn/dynamic_filtered/<stay>.csv                     sep ,   (before dynamic/ if both exist)
<root>/UK_nn/dynamic/dynamische_variablen_kds_patient_<stay>.csv  sep ;

Files are read once, as lines with their file and block, and written to the shared folder. A file's first line is its header: fields
are split by Spark's CSV parser and bind to names through the file's own header, so headers may differ from file to file, also in
order or case. A row's ordinal comes from its place in its block and the rows of all blocks and files before, so it doesn't depend on
how a read is split. Folders are listed through Spark's file system, so any store works.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators.checks import require_none
from ..plans import fixed
from .staging import broadcast_up_to, running_total, stage

# Names of files and folders, id columns, texts for a missing value, the site with decimal commas.
STATIC_FILE = "static/andere_variablen_kds_patienten.csv"
DYNAMIC_LAYOUTS = {"dynamic_filtered": (",", r"([^/]+)\.csv$"), "dynamic": (";", r"dynamische_variablen_kds_patient_([^/]+)\.csv$")}
ID_ALIASES = ["Pseudo-ID", "PseudoID"]
NOT_AVAILABLE = ["storniert", "storno", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
COMMA_SITE, COMMA_LAYOUT = "UK_01", "dynamic"
MINUTES = "Zeit_ab_Aufnahme"

#: Rows of the table of blocks (some 150 bytes each), and of distinct headers, up to which they are sent to every executor.
BLOCKS, HEADS = 300_000, 10_000


def site_folders(spark: SparkSession, root: str) -> list[str]:
    """The sites' folders, in order of their names."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith("UK_"))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def hospital_name(folder: str) -> str:
    """`.../UK_01` is `asic_UK01`."""
    return "asic_" + folder.rstrip("/").rsplit("/", 1)[-1].replace("_", "")


def dynamic_layout(spark: SparkSession, folder: str) -> str:
    for layout in DYNAMIC_LAYOUTS:
        if exists(spark, f"{folder}/{layout}"):
            return layout
    raise FileNotFoundError(f"{folder} has neither {' nor '.join(DYNAMIC_LAYOUTS)}")


def read_translation(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """A translation file {section: {raw column: canonical column}}, from any store."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


@dataclass(frozen=True)
class Export:
    """Raw rows of one kind. rows: head, hospital_id, row_ord and values (an array); heads: head, hospital_id and names (of the values)."""

    kind: str
    rows: DataFrame
    heads: DataFrame


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """hospital_id, layout, file, at (start of the block), mid (rises along a block) and value of every line that isn't blank: the one read."""
    meta = F.col("_metadata")
    text = spark.read.text(list(paths)).select(F.regexp_replace("value", "\r$", "").alias("value"), meta["file_path"].alias("file"), meta["file_block_start"].alias("at"))
    text = text.where(F.trim("value") != "").withColumn("mid", F.monotonically_increasing_id())
    site = F.regexp_extract("file", r"/(UK_[^/]*)/[^/]+/[^/]+$", 1)
    layout = F.regexp_extract("file", r"/([^/]+)/[^/]+$", 1)
    return text.select(F.concat(F.lit("asic_"), F.replace(site, F.lit("_"), F.lit(""))).alias("hospital_id"), layout.alias("layout"), "file", "at", "mid", "value")


def blocks_of(lines: DataFrame) -> DataFrame:
    """file, at, hospital_id, layout, header, header_mid (in a file's first block) and base: the row ordinal of a line is mid + base."""
    first = F.when(F.col("at") == 0, F.struct("mid", "value"))
    blocks = lines.groupBy("hospital_id", "layout", "file", "at").agg(F.min("mid").alias("first"), F.count("*").alias("n"), F.min(first).alias("top"))
    blocks = stage(blocks, "raw-blocks")
    files = blocks.groupBy("hospital_id", "file").agg((F.sum("n") - 1).alias("rows"), F.max("top.value").alias("header"))
    files = running_total(files, ["hospital_id", "file"], "rows", "start").select("file", "header", "start")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return blocks.withColumn("before", before).join(files, "file").select("file", "at", "hospital_id", "layout", "header", F.col("top.mid").alias("header_mid"), (F.col("start") + F.col("before") - 1 - F.col("first")).alias("base"))


def separated(text: Column, layout: Column, width: int) -> Column:
    """The fields of a CSV line as an array of that width."""
    schema = ", ".join(f"_{i} string" for i in range(width))
    parse = lambda sep: F.from_csv(text, F.lit(schema), {"sep": sep, "escape": '"'})
    fields = F.when(layout == "dynamic_filtered", parse(DYNAMIC_LAYOUTS["dynamic_filtered"][0])).otherwise(parse(";"))
    return F.array(*[fields[f"_{i}"] for i in range(width)])


def read_export(spark: SparkSession, paths: Sequence[str], kind: str) -> Export | None:
    """The rows of all files below ``paths``; None without files.

    Every row has both id columns, of a time series from the file's name (other ids in it are passed over), and a time series has `Time`,
    made from the minutes since admission where its header has none.
    """
    lines = stage(lines_of(spark, paths), f"raw-lines-{kind}")
    blocks = stage(blocks_of(lines), f"raw-places-{kind}")
    width = blocks.agg(F.max(F.size(F.split("header", "[,;]")))).first()[0]
    if width is None:
        return None
    kinds = blocks.where("at = 0").groupBy("hospital_id", "layout", "header").agg(F.min("file").alias("file"))
    number = running_total(kinds.withColumn("one", F.lit(1)), ["hospital_id", "layout", "header"], "one", "head")
    names = F.transform(separated(F.col("header"), F.col("layout"), width), F.trim)
    heads = stage(number.select("head", "hospital_id", "layout", "header", "file", names.alias("names")), f"raw-heads-{kind}")
    repeated = F.filter("names", lambda n: n.isNotNull() & (F.size(F.filter("names", lambda m: m == n)) > 1))
    require_none(heads.select("hospital_id", F.array_distinct(repeated).alias("repeated")).where(F.size("repeated") > 0), "column names twice in a header")
    if kind == "static":
        none = heads.where(F.greatest(*[F.array_position("names", n) for n in ID_ALIASES]) == 0).limit(1).collect()
        if none:
            raise KeyError(f"{none[0]['file']} has no stay id column ({', '.join(ID_ALIASES)})")
    known = blocks.join(broadcast_up_to(heads.select("hospital_id", "layout", "header", "head"), HEADS), ["hospital_id", "layout", "header"])
    known = stage(known.select("file", "at", "base", "header_mid", "head"), f"raw-known-{kind}")
    rows = lines.join(broadcast_up_to(known, BLOCKS), ["file", "at"]).where(~F.col("mid").eqNullSafe(F.col("header_mid")))
    rows = rows.join(broadcast_up_to(heads.select("head", "names"), HEADS), "head")
    rows = rows.select("head", "hospital_id", "layout", "file", "names", (F.col("mid") + F.col("base")).alias("row_ord"), separated(F.col("value"), F.col("layout"), width).alias("values"))
    made_time = (F.array_position("names", MINUTES) > 0) & (F.array_position("names", "Time") == 0)
    named = lambda n: F.get("values", (F.array_position("names", n) - 1).cast("int"))  # noqa: E731  null at a place below 0
    ids = [F.when(F.array_position("names", n) > 0, X.clean(named(n))) for n in ID_ALIASES]
    if kind == "static":
        conflict = rows.where(F.size(F.array_distinct(F.filter(F.array(*[X.local_stay_id(i) for i in ids]), lambda x: x.isNotNull()))) > 1)
        require_none(conflict.select("hospital_id", *[i.alias(n) for i, n in zip(ids, ID_ALIASES)]), "stay ids conflict")
        rows = rows.withColumn("_id", F.coalesce(*ids))
    else:
        of_file = F.when(F.col("layout") == "dynamic", F.regexp_extract("file", DYNAMIC_LAYOUTS["dynamic"][1], 1)).otherwise(F.regexp_extract("file", DYNAMIC_LAYOUTS["dynamic_filtered"][1], 1))
        require_none(blocks.where("at = 0").where(of_file == "").select("file"), "file names without a stay id")
        rows = rows.withColumn("_id", of_file)
        comma = (F.col("hospital_id") == hospital_name(COMMA_SITE)) & (F.col("layout") == COMMA_LAYOUT)
        rows = rows.withColumn("values", F.transform("values", lambda v: F.when(comma, value_text(v, True)).otherwise(value_text(v, False))))
        minutes = X.time_text(F.round(X.number(named(MINUTES)) * 60_000_000))
        rows = rows.withColumn("_time", F.when(made_time, minutes))
    own = F.filter("values", lambda v, i: ~F.coalesce(F.get("names", i), F.lit("")).isin(*ID_ALIASES))
    more = [F.col("_id")] * len(ID_ALIASES) + ([F.col("_time")] if kind == "dynamic" else [])
    rows = stage(rows.select("head", "hospital_id", "row_ord", F.concat(own, F.array(*more)).alias("values")), f"raw-{kind}-rows")
    left = F.filter("names", lambda n: ~F.coalesce(n, F.lit("")).isin(*ID_ALIASES))
    # a made time has a name only where its header has none
    time = F.when(made_time, F.lit("Time"))
    heads = stage(heads.select("head", "hospital_id", F.concat(left, F.array(*map(F.lit, ID_ALIASES), *([time] if kind == "dynamic" else []))).alias("names")), f"raw-{kind}-heads")
    return Export(kind, rows, heads)


def load_sites(spark: SparkSession, root: str, kind: str) -> Export:
    """All sites' raw rows of a kind (static or dynamic), in one read."""
    folders = site_folders(spark, root)
    paths = [f"{f}/{STATIC_FILE}" if kind == "static" else f"{f}/{dynamic_layout(spark, f)}" for f in folders]
    found = read_export(spark, paths, kind) if paths else None
    if found is None:
        raise FileNotFoundError(f"{root} has no site with {kind} files")
    return found


def by_name(export: Export) -> DataFrame:
    """The rows under their raw names as columns; names that differ by case only are aliases, which must agree, and the first stays."""
    names = [r[0] for r in export.heads.select(F.explode("names").alias("n")).where("n IS NOT NULL").groupBy("n").agg(F.count("*").alias("c")).orderBy("n").collect()]
    check_aliases(export, {n.lower(): [m for m in names if m.lower() == n.lower()] for n in names})
    rows = export.rows.join(broadcast_up_to(export.heads.drop("hospital_id"), HEADS), "head")
    first = {n.lower(): [m for m in names if m.lower() == n.lower()] for n in names}
    column = lambda n: F.get("values", (F.array_position("names", n) - 1).cast("int"))
    return rows.select("hospital_id", "row_ord", *[F.coalesce(*map(column, same)).alias(same[0]) for same in first.values()])


def load_static(spark: SparkSession, folder: str) -> DataFrame:
    """A site's static rows as text under their raw names, with hospital_id and both id columns filled from whichever there is."""
    return by_name(read_export(spark, [f"{folder}/{STATIC_FILE}"], "static")).drop("row_ord")


def load_dynamic(spark: SparkSession, folder: str) -> DataFrame | None:
    """A site's time-series rows as text under their raw names with the stay's id from the file name, `Time`, and row_ord; None without files."""
    export = read_export(spark, [f"{folder}/{dynamic_layout(spark, folder)}"], "dynamic")
    return None if export is None else by_name(export)


def value_text(c: Column, comma: bool) -> Column:
    """Text without the words for a missing value; with ``comma``, numbers with a decimal comma get a point."""
    text = F.when(~F.coalesce(c, F.lit("")).isin(*NOT_AVAILABLE), c)
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+,[0-9]+\s*$"), F.regexp_replace(text, ",", ".")).otherwise(text) if comma else text


def placed(export: Export, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """The rows with ``places``: for each canonical column of ``mapping`` the places of its raw columns in ``values``, in alias order."""
    table = F.array(*[F.array(*map(F.lit, raws)) for raws in mapping.values()])
    found = lambda raws: F.filter(F.transform(raws, lambda r: (F.array_position("names", r) - 1).cast("int")), lambda p: p >= 0)
    heads = export.heads.select("head", "names", F.transform(table, found).alias("places"))
    return export.rows.join(broadcast_up_to(heads, HEADS), "head")


def check_aliases(export: Export, mapping: Mapping[str, Sequence[str]]) -> None:
    """Aliases of one canonical column must agree in every row, null with null."""
    texts = lambda ps: F.array_distinct(F.transform(ps, lambda p: F.struct(X.clean(F.get("values", p)).alias("v"))))
    rows = placed(export, mapping).select("hospital_id", "names", "values", F.explode("places").alias("at")).where((F.size("at") > 1) & (F.size(texts(F.col("at"))) > 1))
    for r in rows.limit(1).collect():
        at = sorted(r["at"])
        other = next((p for p in at if (r["values"][p] or "").strip() != (r["values"][at[0]] or "").strip()), at[1])
        raise ValueError(f"aliases {r['names'][at[0]]} and {r['names'][other]} disagree: {r['hospital_id']} has {r['values'][at[0]]} and {r['values'][other]}")


def canonical_text(export: Export, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """The rows under canonical names, the first alias with a value before others."""
    first = lambda ps: F.get(F.filter(F.transform(ps, lambda p: X.clean(F.get("values", p))), lambda v: v.isNotNull()), F.lit(0))
    extra = ["hospital_id"] + (["row_ord"] if export.kind == "dynamic" else [])
    rows = placed(export, mapping).select(*extra, F.transform("places", first).alias("_texts"))
    return rows.select(*extra, *[F.get("_texts", F.lit(i)).alias(name) for i, name in enumerate(mapping)])


def load_all(spark: SparkSession, root: str, kind: str, translation: Mapping[str, str] | None = None, export: Export | None = None) -> DataFrame:
    """All sites' rows of a kind (static or dynamic) as one table of text under canonical names.

    Aliases of a static column must agree; row_ord is a row's place over all sites. translation: {raw column: canonical column} in place
    of the built-in one; export: what `load_sites` gave, if it was called before.
    """
    mapping = fixed.raw_columns(kind, translation)
    export = export or load_sites(spark, root, kind)
    if kind == "static":
        check_aliases(export, mapping)
    return canonical_text(export, mapping)


def columns_of(export: Export) -> DataFrame:
    """hospital_id and column: the raw columns that each site's files have."""
    return export.heads.select("hospital_id", F.explode("names").alias("column")).where("column IS NOT NULL").distinct()


def values_of(export: Export, translation: Mapping[str, str] | None = None) -> DataFrame:
    """Raw dynamic texts in long form: hospital_id, column (raw name), canonical_name and text."""
    canonical = {raw: name for name, raws in fixed.raw_columns("dynamic", translation).items() for raw in raws if name not in fixed.TEXT_COLUMNS}
    table = F.create_map(*[F.lit(x) for pair in canonical.items() for x in pair])
    names = export.heads.select("head", "names", F.transform("names", lambda n: F.element_at(table, n)).alias("to"))
    rows = export.rows.join(broadcast_up_to(names, HEADS), "head")
    texts = F.filter(F.transform("values", lambda v, i: F.struct(F.get("names", i).alias("column"), F.get("to", i).alias("canonical_name"), X.clean(v).alias("text"))), lambda x: x["canonical_name"].isNotNull() & x["text"].isNotNull())
    return rows.select("hospital_id", F.explode(texts).alias("x")).select("hospital_id", "x.*")
