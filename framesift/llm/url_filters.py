"""URL filters with dated lists.

A list is a log of dated entries per key. Each entry holds from its date to the next one of its key,
which turns the log into validity intervals; every capture is then judged by the entries in force when
it was fetched. The most specific key decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16

# What a list entry says from its date on. Of entries with one key and date the later here counts.
ACTIONS = ("end", "allow", "block")


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port or trailing dot; NULL where there is none."""
    host = F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(F.length(host) > 0, host)


def path_of(url: Column) -> Column:
    """Path without query and fragment."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(/[^?#]*)", 1)


def keys_of(url: Column) -> Column:
    """Every key that can list this URL: its host, the domains above it of two labels or more, and
    host/folder for each leading run of path segments."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    upper = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))
    )
    segments = F.array_remove(F.split(path_of(url), "/"), "")
    lower = F.when(
        F.size(segments) > 0, F.transform(F.sequence(F.lit(1), F.size(segments)), lambda i: F.concat(host, F.lit("/"), F.concat_ws("/", F.slice(segments, 1, i))))
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(upper, lower)))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals (key, action, valid_from, valid_to) of a log (key, action, dated).

    Entries without key or date are ignored, as they cannot be in force; unknown actions are an error.
    An open interval has no ``valid_to``.
    """
    strength = F.array_position(F.array(*[F.lit(a) for a in ACTIONS]), F.col("action"))
    known = F.when(strength > 0, strength).otherwise(F.raise_error(F.concat(F.lit("unknown list action: "), F.coalesce(F.col("action"), F.lit("NULL")))).cast("bigint"))
    dated = entries.filter(F.col("key").isNotNull() & F.col("dated").isNotNull())
    last = dated.groupBy("key", "dated").agg(F.max(known).alias("_strength"))
    upto = F.lead("dated").over(Window.partitionBy("key").orderBy("dated"))
    spans = last.select("key", F.element_at(F.array(*[F.lit(a) for a in ACTIONS]), F.col("_strength").cast("int")).alias("action"), F.col("dated").alias("valid_from"), upto.alias("valid_to"))
    return spans.filter(F.col("action") != "end")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_on") -> DataFrame:
    """Captures with ``kept``, ``matched_key``, ``matched_action`` and ``matched_from``.

    A capture is dropped (kept = false) when the longest of its keys that is in force at fetch time
    says block. A missing or unreadable URL and a missing date match nothing and are kept. Repeated
    captures are judged alike and all returned; columns of the four names are replaced.

    Each (URL, date) is judged once. One host may own a third of them, so the join on keys is salted:
    keys spread over ``SALTS`` groups and the list, which is small next to the captures, is repeated
    for each.
    """
    marks = ["kept", "matched_key", "matched_action", "matched_from"]
    base = captures.select(*[c for c in captures.columns if c.lower() not in marks])
    asked = base.filter(F.col(url).isNotNull() & F.col(fetched).isNotNull()).select(F.col(url).alias("_url"), F.col(fetched).alias("_at")).distinct()
    salted = asked.select("_url", "_at", F.explode(keys_of(F.col("_url"))).alias("key")).withColumn("_salt", F.pmod(F.xxhash64("_url"), F.lit(SALTS)))
    spans = intervals(entries).withColumn("_salt", F.explode(F.array([F.lit(s).cast("bigint") for s in range(SALTS)])))
    active = salted.join(spans, ["key", "_salt"]).filter((F.col("valid_from") <= F.col("_at")) & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to"))))
    longest = active.groupBy("_url", "_at").agg(F.max(F.struct(F.length("key").alias("n"), "key", "action", "valid_from")).alias("m"))
    out = base.join(longest, (base[url] == longest["_url"]) & (base[fetched] == longest["_at"]), "left")
    return out.select(
        *[base[c] for c in base.columns],
        (F.coalesce(F.col("m.action"), F.lit("none")) != "block").alias("kept"),
        F.col("m.key").alias("matched_key"),
        F.col("m.action").alias("matched_action"),
        F.col("m.valid_from").alias("matched_from"),
    )
