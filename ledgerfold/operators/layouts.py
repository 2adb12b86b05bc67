"""Reports whose headers differ: headers are rows, and cells reach columns by position.

A layout is one distinct header. Its names are resolved by a join with a mapping table, and each
canonical name keeps the positions that carry it; a line then takes, for every name, the first non-null
cell of those positions. The plan is the same for one layout and for thousands."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bind, detect_currency, strip
from .joins import join_unique

BOM = "﻿"
#: Columns that one folder's layouts may have together: they become columns of one frame.
MAX_NAMES = 10_000
#: Columns of a frame by name that are not report columns.
INNER = ("account_id", "row_no", "layout", "cells", "header", "names", "source")


def record_cells(record: Column, separator: str = ",") -> Column:
    """The cells of one CSV record, however many: quotes are removed, doubled quotes are one, empty
    cells are null. Text behind a closing quote stays with its cell as it is."""
    stop = re.escape(separator)
    quoted = '"[^"]*+(?:""[^"]*+)*+"'
    cells = F.regexp_extract_all(F.concat(record, F.lit(separator)), F.lit(f"({quoted}|[^{stop}]*+){stop}"), 1)
    whole = lambda c: F.startswith(c, F.lit('"')) & c.rlike(f"(?s)^{quoted}$")                       # noqa: E731
    inner = lambda c: F.nullif(F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"')), F.lit(""))
    return F.transform(cells, lambda c: F.when(whole(c), inner(c)).when(c != "", c))


def clean_names(cells: Column) -> Column:
    """Header cells without white space around them and without a byte-order mark."""
    return F.transform(cells, lambda c: strip(F.ltrim(strip(F.coalesce(c, F.lit(""))), F.lit(BOM))))


def layout_id(header: Column) -> Column:
    """One id for equal headers."""
    return F.sha2(F.to_json(header), 256)


def header_mapping(spark: SparkSession, names: Mapping[str, str]) -> DataFrame:
    """Header texts and canonical names as a table (`key` in lower case, `canonical`)."""
    return spark.createDataFrame([(k.lower(), v) for k, v in names.items()], "key string, canonical string").dropDuplicates(["key"])


def canonical_slots(layouts: DataFrame, mapping: DataFrame, merge: bool = True) -> DataFrame:
    """(layout, name, places): the columns of every layout (`layout`, `header`) and the positions
    they are read from, in order.

    Unknown headers keep their name; an empty one is named by its position. With `merge`, headers
    of digits only (unnamed columns) are left out and headers that meet in a canonical name share its positions.
    A header repeated without that gets its position appended, whatever its case."""
    at = layouts.select("layout", F.posexplode("header").alias("place", "head"))
    at = at.withColumn("head", F.when(F.col("head") == "", F.col("place").cast("string")).otherwise(F.col("head")))
    if merge:
        at = at.where(~F.rlike("head", F.lit(r"^\p{Nd}+$")))
    known = join_unique(at, mapping, [(F.lower("head"), "key")], "left")
    named = known.withColumn("name", F.coalesce("canonical", "head"))
    groups = named.groupBy("layout", F.lower("name").alias("_key")).agg(
        F.array_sort(F.collect_list(F.struct("place", "name", F.col("canonical").isNotNull().alias("mapped")))).alias("met"))
    first = F.struct(F.col("met")[0]["name"].alias("name"), F.transform("met", lambda m: m["place"]).alias("places"))
    each = F.transform("met", lambda m, i: F.struct(
        F.when(i == 0, m["name"]).otherwise(F.concat(m["name"], F.lit("__"), m["place"].cast("string"))).alias("name"), F.array(m["place"]).alias("places")))
    shared = F.exists("met", lambda m: m["mapped"]) & F.lit(merge)
    slot = F.explode(F.when(shared, F.array(first)).otherwise(each)).alias("slot")
    return groups.select("layout", slot).select("layout", "slot.name", "slot.places")


def column_names(slots: DataFrame) -> list[str]:
    """The names of all layouts together, of those that differ in case only the smallest."""
    found = slots.groupBy(F.lower("name").alias("k")).agg(F.min("name").alias("name")).limit(MAX_NAMES + 1).collect()
    if len(found) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} different columns in one folder")
    return sorted(r["name"] for r in found)


def column_plan(layouts: DataFrame, slots: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row a layout: its `header`, the lower-case `names` it has, and `places`, positions for each of
    the given names (null where it lacks the name). A layout without a usable header has no names."""
    held = slots.groupBy("layout").agg(F.map_from_entries(F.collect_list(F.struct(F.lower("name"), F.col("places")))).alias("slots"))
    wanted = F.array(*[F.lit(n.lower()) for n in names]).cast("array<string>")
    plan = layouts.join(held, "layout", "left")
    return plan.select("layout", "header", F.coalesce(F.map_keys("slots"), F.array().cast("array<string>")).alias("names"),
                       F.transform(wanted, lambda n: F.try_element_at(F.col("slots"), n)).alias("places"))


def by_name(lines: DataFrame, plan: DataFrame, names: Sequence[str]) -> DataFrame:
    """Lines (with `layout` and `cells`) with one text column for each name, null where the line's
    layout lacks it. A report column with an inner name becomes row_<name>."""
    first = lambda places: F.get(F.filter(F.transform(places, lambda p: F.get("cells", p)), lambda c: c.isNotNull()), F.lit(0))
    joined = join_unique(lines, plan.withColumnRenamed("layout", "_layout"), [(F.col("layout"), "_layout")], "inner")
    valued = joined.withColumn("_values", F.transform("places", lambda p: F.when(p.isNotNull(), first(p)))).drop("places")
    taken = {c.lower() for c in valued.columns} | set(INNER)
    return valued.select(*[c for c in valued.columns if c != "_values"], *[
        F.get("_values", F.lit(i)).alias(f"row_{n.lower()}" if n.lower() in taken else n) for i, n in enumerate(names)])


def first_currency(cells: Column) -> Column:
    """First currency detected in an array of cells."""
    return F.get(F.filter(F.transform(cells, detect_currency), lambda c: c.isNotNull()), F.lit(0))


def value_currency(cells: Column, header: Column, label: str = "month") -> Column:
    """First currency of a row's cells, those under the label column left out."""
    return bind(header, lambda h: first_currency(F.filter(cells, lambda c, i: F.lower(F.coalesce(F.get(h, i), F.lit(""))) != label)))


def best_source(files: DataFrame) -> DataFrame:
    """Of each account's files (`account_id`, `source`, …) those of its best source, the smallest `source`.
    Accounts are reduced before the shuffle; files of one account and source all stay."""
    best = files.groupBy(F.col("account_id").alias("_a")).agg(F.min("source").alias("_best"))
    return join_unique(files, best, [(F.col("account_id"), "_a")], "inner").where(F.col("source") == F.col("_best")).drop("_best")
