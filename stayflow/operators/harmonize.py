"""Raw exports to the canonical static and time-series tables: aliases, recodes, numbers, identifiers, lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..plans import fixed
from .checks import require_none


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def present(df: DataFrame, raw: Sequence[str]) -> list[str]:
    """The columns of ``df`` with exactly these names; Spark's own lookup would ignore case."""
    return [r for r in raw if r in df.columns]


def check_aliases(df: DataFrame, mapping: Mapping[str, Sequence[str]]) -> None:
    """Aliases of one canonical column must agree in every row, null with null."""
    for canonical, raw in mapping.items():
        have = present(df, raw)
        for other in have[1:]:
            require_none(df.where(~X.clean(quoted(have[0])).eqNullSafe(X.clean(quoted(other)))).select(quoted(have[0]), quoted(other)), f"aliases of {canonical} disagree")


def merged(df: DataFrame, raw: Sequence[str]) -> Column:
    """The first alias that has a value; null if the table has none of them."""
    have = present(df, raw)
    return F.coalesce(*[X.clean(quoted(r)) for r in have]) if have else F.lit(None).cast("string")


# Recodes of clean text: branches of a `when` are not shared, so text that is trimmed inside them is trimmed in each.


def recode_sex(c: Column) -> Column:
    upper = F.upper(c)
    return F.when(upper == "W", "F").otherwise(upper)


def recode_bmi(c: Column) -> Column:
    upper = F.upper(c)
    out = F.when(upper.isin(*fixed.BMI_MISSING), F.lit(None))
    for code, label in fixed.BMI_GROUPS.items():
        out = out.when(upper == code, label)
    return out.otherwise(upper)


def hospital_mortality(c: Column) -> Column:
    """From the reason of discharge: a transfer is 0, also when a death is named beside it."""
    text = F.lower(c)
    return F.when(text.contains("verlegt"), 0).when(text.contains("verstorben") | text.contains("verstoben"), 1)


def icu_mortality(c: Column) -> Column:
    text = F.upper(c)
    return F.when(text == "ICU", 1).when(text.isin("0", "KH"), 0)


def without_minus_one(c: Column) -> Column:
    return F.when(~c.isin("-1", "-1.0"), c)


def whole_number(n: Column) -> Column:
    """A long where the number has no fraction, else null."""
    return F.when(n == F.floor(n), n).cast("long")


def harmonize_static(raw: DataFrame, hospital: str | Column, mapping: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The canonical static table of raw rows; columns that the export lacks are null.

    Numbers are parsed as an array, by one expression however many they are; this also ends the generated code of the texts' step. All in one
    would be a method of over 8,000 bytes, which the JVM leaves uncompiled.
    """
    names = [c for c in fixed.STATIC_COLUMNS if c not in ("hospital_id", "stay_id_global")]
    text = _static_text(raw, hospital, mapping, names)
    text = text.withColumns({c: X.clean(c) for c in ("sex", "weight_group", "bmi_group")})  # twice, for what a line separator at the end hid
    get = {name: F.col(name) for name in names}
    numbers = [name for name in fixed.STATIC_NUMBERS if name not in ("hosp_mortality", "icu_mortality")]
    get |= {name: without_minus_one(get[name]) for name in fixed.MINUS_ONE_MISSING if name not in numbers}
    get |= {"sex": recode_sex(get["sex"]), "bmi_group": recode_bmi(get["bmi_group"]), "hosp_mortality": hospital_mortality(get["hosp_mortality"]), "icu_mortality": icu_mortality(get["icu_mortality"])}
    get |= {name: get[name].cast("long") for name in ("hosp_mortality", "icu_mortality")}
    get["stay_id_local"] = X.local_stay_id(F.col("stay_id_local"))
    parsed = F.transform(F.transform(F.array(*numbers), lambda t: X.number(without_minus_one(t))), whole_number)
    out = text.select("hospital_id", *[get[c].alias(c) for c in names if c not in numbers], parsed.alias("_numbers"))
    out = out.withColumns({c: F.get("_numbers", F.lit(i)) for i, c in enumerate(numbers)} | {"stay_id_global": X.global_stay_id("hospital_id", "stay_id_local")})
    return out.select(*fixed.STATIC_COLUMNS)


def _static_text(raw: DataFrame, hospital: str | Column, mapping: Mapping[str, Sequence[str]] | None, names: Sequence[str]) -> DataFrame:
    """hospital_id and the merged, trimmed text of canonical columns, as a step of its own so that later expressions stay small."""
    mapping = mapping or fixed.raw_columns("static")
    site = F.lit(hospital) if isinstance(hospital, str) else hospital
    return raw.select(site.alias("hospital_id"), *[merged(raw, mapping.get(c, [])).alias(c) for c in names])


def unexpected_categories(raw: DataFrame, hospital: str | Column, mapping: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Values that no recode knows: hospital_id, column, value, n."""
    names = ["sex", "bmi_group", "hosp_mortality", "icu_mortality"]
    text = _static_text(raw, hospital, mapping, names)
    long = text.select("hospital_id", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in names])).alias("x")).select("hospital_id", "x.column", "x.value")
    counts = long.where("value IS NOT NULL").groupBy("hospital_id", "column", "value").agg(F.count("*").alias("n"))
    v, upper = F.col("value"), F.upper("value")
    known = F.when(F.col("column") == "sex", upper.isin("M", "F", "W")).when(F.col("column") == "bmi_group", upper.isin(*fixed.BMI_GROUPS, *fixed.BMI_MISSING)).when(F.col("column") == "hosp_mortality", hospital_mortality(v).isNotNull()).otherwise(icu_mortality(v).isNotNull())
    return counts.where(~known)


def numeric_value(text: Column, variable: str | Column, hospital: Column, laboratory_site: str = fixed.LABORATORY_SITE) -> Column:
    """A number from raw text: ratios for `ie_ratio`, laboratory strings at the one site that has them, else plain numbers."""
    is_ratio = F.lit(variable == "ie_ratio") if isinstance(variable, str) else variable == "ie_ratio"
    return F.when(is_ratio, X.ie_ratio(text)).when(hospital == laboratory_site, X.laboratory(text)).otherwise(X.number(text))


def harmonize_dynamic_long(raw: DataFrame, hospital: str | Column, mapping: Mapping[str, Sequence[str]] | None = None, laboratory_site: str = fixed.LABORATORY_SITE, cleaned: bool = False) -> DataFrame:
    """The time series in long form: hospital_id, stay ids, time_us, row_ord, variable, value of every text that is a number.

    raw has a column row_ord. The texts are turned to rows first, so the parsers are one expression however many variables there are.
    cleaned: the texts are under canonical names and trimmed already.
    """
    mapping = mapping or fixed.raw_columns("dynamic")
    site = F.lit(hospital) if isinstance(hospital, str) else hospital
    variables = [c for c in fixed.dynamic_columns() if c not in fixed.TEXT_COLUMNS and present(raw, mapping.get(c, []))]
    text = F.filter(F.array(*[F.struct(F.lit(v).alias("variable"), (F.col(v) if cleaned else merged(raw, mapping[v])).alias("text")) for v in variables]), lambda x: x["text"].isNotNull())
    rows = dynamic_rows(raw, site, mapping, text.alias("_texts"))
    long = rows.select("hospital_id", "stay_id_global", "stay_id_local", "time_us", "row_ord", F.explode("_texts").alias("x")).select("*", "x.variable", "x.text").drop("x")
    return long.withColumn("value", numeric_value(F.col("text"), F.col("variable"), F.col("hospital_id"), laboratory_site)).drop("text").where("value IS NOT NULL")


def dynamic_rows(raw: DataFrame, hospital: Column, mapping: Mapping[str, Sequence[str]], *more: Column) -> DataFrame:
    """hospital_id, stay ids, time_us and row_ord of every raw row."""
    ids = raw.select(hospital.alias("hospital_id"), merged(raw, mapping.get("stay_id_local", [])).alias("_id"), merged(raw, mapping.get("time", [])).alias("_time"), "row_ord", *more)
    out = ids.withColumn("stay_id_local", X.local_stay_id("_id")).withColumn("time_us", X.time_us("_time")).drop("_id", "_time")
    return out.withColumn("stay_id_global", X.global_stay_id("hospital_id", "stay_id_local"))


def to_wide(long: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row a source row with any value, and a column for each variable in the order given."""
    return long.groupBy("hospital_id", "stay_id_global", "stay_id_local", "time_us", "row_ord").agg(*[F.max(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in variables])


def source_map(columns: DataFrame, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """Lineage: the raw columns that each hospital (hospital_id, column) offers for each canonical one, in alias order."""
    rows = [(name, raw, i) for name, raws in mapping.items() for i, raw in enumerate(raws)]
    table = columns.sparkSession.createDataFrame(rows, "canonical_name string, column string, _at int")
    sites = columns.select("hospital_id").distinct().join(F.broadcast(table.select("canonical_name").distinct()))
    used = columns.distinct().join(F.broadcast(table), "column").groupBy("hospital_id", "canonical_name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "column"))), lambda x: x["column"]), ",").alias("raw_columns"))
    return sites.join(used, ["hospital_id", "canonical_name"], "left").select("hospital_id", "canonical_name", F.coalesce("raw_columns", F.lit("")).alias("raw_columns"))


def with_themes(sources: DataFrame, themes: Mapping[str, Sequence[str]]) -> DataFrame:
    """theme, canonical_name and raw_columns, each combination that some hospital has; a null theme for names in none."""
    table = sources.sparkSession.createDataFrame([(t, n) for t, names in themes.items() for n in names], "theme string, canonical_name string")
    return sources.join(F.broadcast(table), "canonical_name", "left").select("theme", "canonical_name", "raw_columns").distinct()


def alias_agreement(raw: DataFrame, hospital: Column, a: str, b: str) -> DataFrame:
    """Whether two aliases agree in all rows of each hospital, null with null."""
    differ = F.count_if(~X.clean(quoted(a)).eqNullSafe(X.clean(quoted(b))))
    return raw.groupBy(hospital.alias("hospital_id")).agg(differ.alias("different_rows")).withColumn("agree", F.col("different_rows") == 0)

