"""URL filters by dated lists: which captures were listed at the time they were fetched.

A list is a log of dated changes: a pattern is added or removed. Each addition becomes a validity interval
up to the pattern's next change. Patterns are hosts (``example.com`` also covers its subdomains) or a
host followed by the first parts of a path (``example.com/en``). A capture asks for every pattern that could cover it,
its host and the suffixes of its host, each with the leading path parts, in all numbers of labels and parts that entries
of the list have together, so that matching is an equality, and an as-of join by pattern and span of time picks the entries active at the fetch time.

No step gathers a pattern's changes or a host's captures in one place: the next change is looked up within
(pattern, span) and, for the last one of a span, among the first changes of later spans; the join is by
(pattern, span), broadcast only for a counted number of intervals, else a merge join that adaptive execution can
split.

Results by case: null URLs, URLs without a host and captures without a time match nothing; entries without
pattern, time or action are ignored; of changes of one pattern at the same instant a removal wins; an interval
contains its start and not its end; repeated changes have no effect; repeated captures are judged each, and
those with the same id share their verdict; empty tables match nothing; other columns, whatever their names,
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.work import inner_join, stored

SPAN_DAYS = 7


def host_of(url: str | Column) -> Column:
    """The lower-cased host of a URL, null without one."""
    column = F.col(url) if isinstance(url, str) else url
    host = F.lower(F.regexp_extract(column, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def path_parts(url: str) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda part: part != "")


def depths_of(entries: DataFrame) -> list[tuple[int, int]]:
    """The numbers of labels and path parts that patterns have together."""
    parts = F.split("pattern", "/")
    labels = F.split(F.element_at(parts, 1), r"\.")
    found = entries.select(F.size(labels).alias("labels"), (F.size(parts) - 1).alias("parts")).distinct()
    return sorted((row["labels"], row["parts"]) for row in found.collect())


def patterns_of(url: str, depths: list[tuple[int, int]]) -> Column:
    """Every pattern of these numbers of labels and path parts that covers a URL."""
    labels, parts = F.split(host_of(url), r"\."), path_parts(url)
    known = F.array(*(F.struct(F.lit(k).alias("labels"), F.lit(n).alias("parts")) for k, n in depths or [(1, 0)]))
    own = F.filter(known, lambda d: (d["labels"] <= F.size(labels)) & (d["parts"] <= F.size(parts)))
    return F.transform(
        own,
        lambda d: F.array_join(
            F.concat(
                F.array(F.array_join(F.slice(labels, -d["labels"], d["labels"]), ".")), F.slice(parts, 1, d["parts"])
            ),
            "/",
        ),
    )


def _span(time: str, days: int) -> Column:
    return F.floor(F.unix_seconds(time) / (86_400 * days))


def intervals(changes: DataFrame, days: int = SPAN_DAYS) -> DataFrame:
    """(pattern, valid_from, valid_to) of the additions among changes (pattern, at, added); null: still valid."""
    known = changes.where("pattern is not null and at is not null and added is not null")
    known = known.select("pattern", F.col("at").cast("timestamp").alias("at"), "added")
    known = known.groupBy("pattern", "at").agg(F.min("added").alias("added")).withColumn("span", _span("at", days))
    known = stored(known, "changes")
    firsts = known.groupBy("pattern", "span").agg(F.min("at").alias("first"))
    later = Window.partitionBy("pattern").orderBy("span")
    firsts = firsts.select("pattern", "span", F.lead("first").over(later).alias("later"))
    within = Window.partitionBy("pattern", "span").orderBy("at")
    rows = known.withColumn("next", F.lead("at").over(within)).join(firsts, ["pattern", "span"])
    return rows.where("added").select("pattern", F.col("at").alias("valid_from"), F.coalesce("next", "later").alias("valid_to"))


def listed(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at", days: int = SPAN_DAYS
) -> DataFrame:
    """(id, host, entries, listed), one row per capture: the sorted patterns of the entries active when it was fetched."""
    rows = captures.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(time_col).cast("timestamp").alias("at")
    )
    asked = rows.where("url is not null and at is not null")
    bounds = asked.agg(F.min(_span("at", days)).alias("low"), F.max(_span("at", days)).alias("high")).first()
    low, high = (0, 0) if bounds["low"] is None else bounds
    valid = intervals(entries, days)
    begins = F.greatest(_span("valid_from", days), F.lit(low))
    ends = F.least(F.coalesce(_span("valid_to", days), F.lit(high)), F.lit(high))
    valid = valid.withColumn("begins", begins).withColumn("ends", ends).where("begins <= ends")
    valid = stored(valid.select("pattern", "valid_from", "valid_to", F.explode(F.sequence("begins", "ends")).alias("span")), "intervals")
    asked = asked.select("id", "at", _span("at", days).alias("span"), F.explode(patterns_of("url", depths_of(valid))).alias("pattern"))
    met = inner_join(asked, valid, ["pattern", "span"]).where("at >= valid_from and (valid_to is null or at < valid_to)")
    found = met.groupBy("id").agg(F.array_sort(F.collect_set("pattern")).alias("entries"))
    judged = rows.select("id", host_of("url").alias("host")).join(found, "id", "left")
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        F.coalesce("entries", F.array().cast("array<string>")).alias("entries"),
        F.col("entries").isNotNull().alias("listed"),
    )


def drop_listed(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", **settings) -> DataFrame:
    """The captures that no active entry covered, with all their columns; a row is judged by its id, URL and time."""
    url, time = settings.get("url_col", "url"), settings.get("time_col", "fetched_at")
    keyed = captures.withColumn("__row", F.struct(F.col(id_col).alias("id"), F.xxhash64(url).alias("u"), F.xxhash64(time).alias("t")))
    gone = listed(keyed, entries, id_col="__row", **settings).where("listed").select("__row").distinct()
    return keyed.join(gone, "__row", "left_anti").select(*(F.col(f"`{c}`") for c in captures.columns))
