"""Checks that travel beside the main result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import DIVERGENCE_COLUMNS, Rules
from ..functions import bind, norm_key, platform_key, strip
from .joins import join_unique
from .reference import preferred_rows


def divergences(enriched: DataFrame) -> DataFrame:
    """Rows without a ref. A matched reference row with an empty ref counts too, so
    this is a filter and not an anti-join."""
    return enriched.where(F.col("ref").isNull()).select(*DIVERGENCE_COLUMNS)


def n_parts(c: Column) -> Column:
    return F.size(F.split(c, "_"))


def token_runs(c: Column, lengths: Column) -> Column:
    """Contiguous runs of '_'-separated parts of a text, joined again, of the given
    numbers of parts. A login is a delimited part of a username exactly when it is one
    of the runs with as many parts as the login has."""
    runs = lambda parts: F.flatten(F.transform(                          # noqa: E731
        F.filter(lengths, lambda k: k <= F.size(parts)),
        lambda k: F.transform(F.sequence(F.lit(1), F.size(parts) - k + F.lit(1)),
                              lambda i: F.array_join(F.slice(parts, i, k), "_"))))
    return F.array_distinct(bind(F.split(c, "_"), runs))


def missing_accounts(sheet: DataFrame, accounts: DataFrame) -> DataFrame:
    """Sheet rows with no account in the same brand and platform whose username is
    the sheet's username or a delimited base of it.

    The base test is turned into an equi-join on token runs: comparing every
    username with every login of its scope would be quadratic in the scope. Only runs as
    long as some login of the brand and platform are made, so a username of many parts
    stays linear in its parts."""
    keys = ["_b", "_p", "_u"]
    sheet = sheet.select("*", norm_key(F.col("brand")).alias("_b"),
                         platform_key(F.col("platform")).alias("_p"),
                         norm_key(F.col("username")).alias("_u"))
    logins = accounts.select(norm_key(F.col("brand")).alias("_lb"),
                             platform_key(F.col("platform")).alias("_lp"),
                             norm_key(F.col("username")).alias("_lu")).distinct()
    lengths = logins.groupBy("_lb", "_lp").agg(F.collect_set(n_parts(F.col("_lu"))).alias("_lengths"))
    # An empty run is a base of nothing: it may only meet a login for an empty username.
    scoped = join_unique(sheet.select(*keys).distinct(), lengths, [(F.col("_b"), "_lb"), (F.col("_p"), "_lp")], "inner")
    runs = (scoped.select(*keys, F.explode(token_runs(F.col("_u"), F.col("_lengths"))).alias("_run"))
                 .where((F.col("_run") != "") | (F.col("_u") == "")))
    scope = [(F.col("_b"), "_lb"), (F.col("_p"), "_lp"), (F.col("_run"), "_lu")]
    known = join_unique(runs, logins, scope, "left_semi").select(*[F.col(k).alias(f"_k{k}") for k in keys]).distinct()
    return join_unique(sheet, known, [(F.col(k), f"_k{k}") for k in keys], "left_anti").drop(*keys)


def missing_accounts_report(sheet: DataFrame, accounts: DataFrame,
                            rules: Rules = Rules()) -> DataFrame:
    """Missing accounts of the preferred worksheet rows, in report columns."""
    rows = missing_accounts(preferred_rows(sheet, rules), accounts)
    return rows.select(F.col("brand").alias("empresa"), F.col("platform").alias("plataforma"),
                       F.col("username").alias("usuario_referencia"),
                       F.col("ref").alias("operador_referencia"),
                       F.col("commission").alias("comissao"), F.col("netting").alias("resta"))


def account_outcomes(accounts: DataFrame, reports: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Per account: 'error' (extraction failed or nothing landed), 'no data' (an
    empty report landed) or 'data', with the number of report rows. `log` has one
    row per attempted account: account_id, ok."""
    counts = reports.groupBy(F.col("account_id").alias("_a")).agg(F.count(F.lit(1)).alias("n_rows"))
    out = join_unique(accounts, counts, [(F.col("account_id"), "_a")], "left")
    if log is None:
        ok = F.col("n_rows").isNotNull()
    else:
        tried = log.groupBy(F.col("account_id").alias("_a")).agg(F.max(F.col("ok").cast("boolean")).alias("_ok"))
        out = join_unique(out, tried, [(F.col("account_id"), "_a")], "left")
        ok = F.coalesce(F.col("_ok"), F.lit(False))
    n = F.coalesce(F.col("n_rows"), F.lit(0))
    return (out.withColumn("outcome", F.when(n > 0, "data").when(ok, "no data").otherwise("error"))
               .withColumn("n_rows", n).drop("_ok"))


def load_counters(df: DataFrame, *keys: str) -> DataFrame:
    """Rows seen, without ref, without rate and kept, in one pass."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("ref").isNull()).alias("n_without_ref"),
        F.count_if(F.col("rate").isNull()).alias("n_without_rate"),
        F.count_if(F.col("ref").isNotNull()).alias("n_kept"))


def account_pairs(accounts: DataFrame, ids) -> DataFrame:
    """Lower-case (operator, username) of the accounts with the given ids."""
    if isinstance(ids, DataFrame):
        wanted = ids.select(strip(F.col(ids.columns[0]).cast("string")).alias("_id")).distinct()
        rows = accounts.join(wanted, strip(F.col("account_id")) == F.col("_id"), "left_semi")
    else:
        rows = accounts.where(strip(F.col("account_id")).isin([str(i).strip() for i in ids]))
    return rows.select(norm_key(F.col("operator")).alias("_op"),
                       norm_key(F.col("username")).alias("_un")).distinct()


def filter_union_by_ids(df: DataFrame, accounts: DataFrame | None, ids) -> DataFrame:
    """Rows of the wanted accounts in a union of report shapes: rows that carry an
    account id are matched by it, the others by operator and username. Ids of which none is
    in the registry are an error, whatever the rows carry."""
    if accounts is None:
        raise ValueError("account ids need the account registry")
    named = filter_by_ids(df.where(F.col("account_id").isNull()) if "account_id" in df.columns else df, accounts, ids)
    if "account_id" not in df.columns:
        return named
    if isinstance(ids, DataFrame):
        wanted = ids.select(strip(F.col(ids.columns[0]).cast("string")).alias("_id")).distinct()
    else:
        wanted = df.sparkSession.createDataFrame([(str(i).strip(),) for i in ids], "_id string").distinct()
    own = join_unique(df.where(F.col("account_id").isNotNull()), wanted, [(strip(F.col("account_id")), "_id")], "left_semi")
    return own.unionByName(named)


def filter_by_ids(df: DataFrame, accounts: DataFrame, ids, require: bool = True) -> DataFrame:
    """Rows of the accounts with the given ids. Unknown ids only are an error."""
    pairs = account_pairs(accounts, ids)
    if require and pairs.isEmpty():
        raise ValueError(f"none of the ids is in the account registry: {ids}")
    return join_unique(df, pairs, [(norm_key(F.col("operator")), "_op"), (norm_key(F.col("username")), "_un")],
                       "left_semi")


def split_faults(df: DataFrame, faults: Mapping[str, Column], *keep: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): rows without a fault, and one row for each faulty value with the kept columns, `column`,
    `value` and `reason`. `faults` has the reason of each column's value, null where there is none."""
    if not faults:
        none = df.select(*[F.col(f"`{c}`").cast("string") for c in keep], *[F.lit("").alias(n) for n in ("column", "value", "reason")])
        return df, none.limit(0)
    found = F.filter(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"), fault.alias("reason")) for c, fault in faults.items()]),
                     lambda x: x["reason"].isNotNull())
    good = F.lit(True)
    for fault in faults.values():
        good = good & fault.isNull()
    judged = df.where(~good).withColumn("_faults", found)
    bad = judged.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in keep], F.explode("_faults").alias("_fault"))
    return df.where(good), bad.select(*keep, "_fault.*")
