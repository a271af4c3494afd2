"""Secrets weighed by who owns them (native: DataFrame functions only).

Every text is searched for base secrets (assignments, access keys, long hex
strings) and for tokens in the formats of well-known providers. Each found
value is hashed, and the corpus is asked how many distinct repositories and
owners hold it. A value that ``EXAMPLE_OWNERS`` or more owners hold is a widely
copied example, and so is one in ``EXAMPLE_SPREAD`` or more repositories for each
of its owners: few owners who repeat it everywhere show boilerplate. One that is
owner-specific by both counts and varied enough to be random looks live. Base
spans always stay and carry that verdict; a provider token is added as a span if
it looks live.

Positions come from the lengths of the pieces between matches. Only texts that
match a pattern are taken apart.

Skew: occurrences are reduced to distinct (value, owner, repository) and counted
per owner before they meet by value; the verdicts are checkpointed, so the join
back has an exchange on both sides and Spark can split a value that very many
rows hold.

Edge cases: null text reads as empty. A null owner or repository counts as one
more owner or repository. Rows that repeat an identifier are searched each on
their own and are one repository. An empty table gives an empty result. Other
columns are not read. Positions are code points, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmetrics.llm.common import prepare, settled

# Fixed rules of the base spans: kind, pattern, group of the value, least length of the value.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"""([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Public token formats of well-known providers.
PROVIDER = ("provider", r"(?:gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,64}|AIza[A-Za-z0-9_-]{35}"
                        r"|xox[baprs]-[A-Za-z0-9-]{10,72}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}"
                        r"\.[A-Za-z0-9_-]{8,})", 0, 1)
KINDS = (*BASE, PROVIDER)
EXAMPLE_OWNERS = 3
EXAMPLE_SPREAD = 20  # repositories per owner
VARIED = 6  # different characters of a value that looks random
BLOCK = 256


def running_totals(numbers: Column) -> Column:
    """Sum of each number and all before it, in one pass.

    Totals are gathered in blocks, since adding to an array copies it. ``numbers`` is named
    once, so that whatever computes it is evaluated once and not for every element.
    """
    one = F.array().cast("array<int>")
    start = F.struct(F.lit(0).alias("total"), one.alias("block"),
                     F.array().cast("array<array<int>>").alias("full"))

    def add(acc: Column, x: Column) -> Column:
        total, room = acc["total"] + x, F.size(acc["block"]) < BLOCK
        return F.struct(
            total.alias("total"),
            F.when(room, F.concat(acc["block"], F.array(total))).otherwise(F.array(total)).alias("block"),
            F.when(room, acc["full"]).otherwise(
                F.concat(acc["full"], F.array(acc["block"]))).alias("full"))

    return F.aggregate(numbers, start, add, lambda acc: F.flatten(
        F.concat(acc["full"], F.array(acc["block"]))))


def _spans_of(text: Column, order: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (start, order, end, value) of one kind, leftmost and non-overlapping."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    sizes = F.transform(matches, F.char_length)
    # gap and match lengths, pairwise: each match ends at the running total
    ends = running_totals(F.zip_with(F.slice(gaps, F.lit(1), F.size(sizes)), sizes,
                                     lambda gap, size: gap + size))
    spans = F.transform(F.arrays_zip(sizes.alias("size"), ends.alias("end"), values.alias("value")),
                        lambda x: F.struct((x["size"] * -1 + x["end"]).alias("start"),
                                           F.lit(order).alias("order"), x["end"].alias("end"),
                                           x["value"].alias("value")))
    kept = F.filter(spans, lambda s: F.char_length(s["value"]) >= least)
    return F.when(text.rlike(pattern), kept)


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str) -> DataFrame:
    """(row, id, owner, spans): all candidate spans of each row, their values hashed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(id_col).alias("id"), F.col(owner_col).alias("owner"),
                       text.alias("text"))
    empty = F.array().cast("array<struct<start:int,order:int,end:int,value:string>>")
    found = rows.select("row", "id", "owner", *[
        F.coalesce(_spans_of(F.col("text"), i, *kind), empty).alias(f"k{i}")
        for i, kind in enumerate(KINDS)])
    varied = lambda v: F.size(F.array_distinct(F.filter(F.split(v, ""), lambda c: c != "")))
    return found.select("row", "id", "owner", F.transform(
        F.array_sort(F.concat(*[f"k{i}" for i in range(len(KINDS))])),
        lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"),
                           s["end"].alias("end"), F.sha2(s["value"], 256).alias("value"),
                           (varied(s["value"]) >= VARIED).alias("varied"))).alias("spans"))


def ownership(occurrences: DataFrame) -> DataFrame:
    """(value, n_owners, n_repositories) from rows (value, owner, repository)."""
    per_owner = (occurrences.select("value", "owner", "repository").distinct()
                 .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n")))
    return per_owner.groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"),
                                          F.sum("n").alias("n_repositories"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source") -> DataFrame:
    """Counts, digest and list of spans per row, with how many look live or are examples and
    how many owners and repositories hold the most widely held of them.

    A document is a repository of its owner.
    """
    prepare(docs.sparkSession)
    found = candidates(docs, id_col, text_col, owner_col).transform(settled)
    each = found.select("row", "owner", F.col("id").alias("repository"),
                        F.explode("spans").alias("span"))
    owned = ownership(each.select(F.col("span.value").alias("value"), "owner",
                                  "repository")).transform(settled)
    judged = (each.select("row", "span.*").join(owned, "value")
              .withColumn("example", (F.col("n_owners") >= EXAMPLE_OWNERS)
                          | (F.col("n_repositories") >= EXAMPLE_SPREAD * F.col("n_owners")))
              .withColumn("live", ~F.col("example") & F.col("varied")))
    names = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("order") + 1)
    written = F.concat_ws(":", names, F.col("start"), F.col("end"))
    base = F.col("order") < len(BASE)
    stays = judged.where(base | F.col("live"))
    by_row = stays.groupBy("row").agg(
        *[F.count_if(F.col("order") == i).alias(f"n_{k[0]}") for i, k in enumerate(BASE)],
        F.array_sort(F.collect_list(F.struct("start", "order", written.alias("s"),
                                             base.alias("base")))).alias("all"),
        F.count_if("live").alias("n_live"), F.count_if("example").alias("n_example"),
        F.max("n_owners").alias("most_owners"), F.max("n_repositories").alias("most_repositories"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: x["s"]), ",")
    zero = F.lit(0).cast("long")
    every = F.coalesce(listed("all"), F.lit(""))
    basic = F.coalesce(listed(F.filter("all", lambda x: x["base"])), F.lit(""))
    return (found.select("row", "id").join(by_row, "row", "left")
            .select(F.col("id").alias(id_col),
                    *[F.coalesce(f"n_{k[0]}", zero).alias(f"n_{k[0]}") for k in BASE],
                    F.sha2(basic, 256).alias("base_sha256"), every.alias("spans"),
                    F.coalesce("n_live", zero).alias("n_live"),
                    F.coalesce("n_example", zero).alias("n_example"),
                    F.coalesce("most_owners", zero).alias("most_owners"),
                    F.coalesce("most_repositories", zero).alias("most_repositories")))
