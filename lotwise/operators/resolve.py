"""Entity resolution: components over the union of match rules, and golden records of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.functions import numbers
from lotwise.operators import edges
from lotwise.operators.components import components, extended
from lotwise.schema import GOLDEN, conform
from lotwise.session import cut, kept, release


#: The rules in their order, and what each one reads; A2 and B1 are left out where their first column is none of the rows'.
RULES = {"P1": ("photos",), "A1": ("address", "town", "size"), "A2": ("address_ascii", "town", "size"), "I1": ("listing_key", "portal"), "G1": ("town", "lat", "lng", "size"), "B1": ("project", "town", "size")}


def rules(df: DataFrame, id_col: str = "row_id", names: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Edges of each rule (or of those named), in the order in which merges are counted; A2 needs address_ascii and B1 project among the columns."""
    own = {"P1": lambda: edges.photo_edges(df, id_col=id_col), "A1": lambda: edges.band_edges(df.filter(F.col("address").isNotNull()), ["address", "town"], id_col=id_col)}
    if "address_ascii" in df.columns:
        own["A2"] = lambda: edges.fuzzy_edges(df, "address_ascii", id_col=id_col)
    own |= {"I1": lambda: edges.key_edges(df, id_col=id_col), "G1": lambda: edges.geo_edges(df, id_col=id_col)}
    if "project" in df.columns:
        own["B1"] = lambda: edges.band_edges(df.filter(F.col("project").isNotNull() & F.col("town").isNotNull()), ["project", "town"], id_col=id_col)
    return {name: found() for name, found in own.items() if names is None or name in names}


def union(frames) -> DataFrame:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def label(df: DataFrame, links: DataFrame, id_col: str = "row_id") -> DataFrame:
    """df with cluster_id, the smallest id of the component."""
    named = components(links).withColumnRenamed("node", id_col)
    return df.join(named, id_col, "left").withColumn("cluster_id", F.coalesce("label", id_col)).drop("label")


NUMBER = "__n"


def numbered(df: DataFrame) -> DataFrame:
    """df as a table with a number for each row: edges and components carry numbers instead of ids."""
    return kept(df.withColumn(NUMBER, F.monotonically_increasing_id()), "rows")


def twins(rows: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Edges between rows of one id. Only ids whose hash occurs twice are compared."""
    hashed = rows.select(NUMBER, id_col, F.xxhash64(id_col).alias("h"))
    return edges.star(hashed.join(hashed.groupBy("h").count().filter("count > 1").select("h"), "h", "left_semi"), [id_col], NUMBER)


def linked(rows: DataFrame, found: Iterable[DataFrame], id_col: str = "row_id") -> DataFrame:
    """Number and cluster_id, the smallest id of the component, of the numbered rows that have links to others.

    Each rule's edges are written down before the next one's, so that only one rule's shuffle files are on disk.
    """
    links = [kept(f, "links") for f in chain([twins(rows, id_col)], found)]
    labels = kept(components(union(links), tables=True), "labels")
    release(*links)
    ids = rows.select(F.col(NUMBER).alias("node"), id_col)
    names = labels.join(ids, "node").groupBy("label").agg(F.min(id_col).alias("cluster_id"), F.max(id_col).alias("last")).filter("cluster_id <> last").drop("last")
    return labels.join(kept(names, "names"), "label").select(F.col("node").alias(NUMBER), "cluster_id")


def labelled(df: DataFrame, found: Callable[[DataFrame], Iterable[DataFrame]], id_col: str = "row_id") -> DataFrame:
    """df with cluster_id, the smallest id of the component, by the edges that found() makes of the numbered rows."""
    rows = numbered(df)
    return rows.join(linked(rows, found(rows), id_col), NUMBER, "left").withColumn("cluster_id", F.coalesce("cluster_id", id_col)).drop(NUMBER)


def labelled_by(df: DataFrame, names: tuple[str, ...] | None = None) -> DataFrame:
    """df with cluster_id by the rules of these names, or by all."""
    return labelled(df, lambda rows: rule_by_rule(rows, names))


def rule_by_rule(rows: DataFrame, names: tuple[str, ...] | None = None) -> Iterator[DataFrame]:
    """Edges of one rule after the other, each made when it is asked for."""
    for name in names_of(rows, names):
        yield rules(rows, NUMBER, (name,))[name]


def names_of(rows: DataFrame, names: tuple[str, ...] | None = None) -> list[str]:
    return [n for n, read in RULES.items() if (names is None or n in names) and (n not in ("A2", "B1") or read[0] in rows.columns)]


def merge_counts(df: DataFrame) -> DataFrame:
    """rule, merges: how many components each rule, in order, takes away from what the rules before left."""
    read = dict.fromkeys(["row_id", *chain(*[RULES[n] for n in names_of(df)])])
    spark, out, rows = df.sparkSession, [], numbered(df.select(*read))
    labels = kept(components(twins(rows), tables=True), "labels")
    before = labels.filter("node <> label").count()  # rows of one id are one
    for name, found in zip(names_of(rows), rule_by_rule(rows), strict=True):
        links = kept(found, "links")
        more = kept(extended(labels, links, tables=True), "labels")
        release(labels, links)
        labels = more
        gone = labels.filter("node <> label").count()  # rows that aren't their component's name
        out.append((name, gone - before))
        before = gone
    release(labels, rows)
    return spark.createDataFrame(out, "rule string, merges long")


class Choice:
    """How golden records pick a row: the newest one, or the one of the best portal."""

    def __init__(self, df: DataFrame) -> None:
        stamp = F.unix_micros(F.try_to_timestamp(F.col("updated_at").cast("string")))
        self.age = F.coalesce(-stamp, F.lit(1 << 62))  # without a date: the oldest
        self.newest = F.struct(self.age.alias("age"), F.col("portal_rank"), F.col("row_id"))
        self.best = F.struct(F.col("portal_rank"), self.age.alias("age"), F.col("row_id"))
        self.columns = set(df.columns)

    def first(self, name: str, value: str | Column, order: Column, ok: Column | None = None) -> list[Column]:
        """__name: the value of the first row that has one, and __name_from: that row's portal and url, which Catalyst drops where no one asks for it."""
        c = (F.col(value) if value in self.columns else F.lit(None).cast("string")) if isinstance(value, str) else value
        ok = c.isNotNull() if ok is None else ok
        at = F.when(ok, order)
        return [F.min_by(F.when(ok, c), at).alias(f"__{name}"), F.min_by(F.when(ok, F.struct("portal", "url")), at).alias(f"__{name}_from")]


BIG = 10_000  # rows of a cluster that a task gathers before they are aggregated


def by_size(df: DataFrame, records: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """records() of the clusters of df, which is read several times.

    Clusters of few rows are gathered first: a row is smaller than the state of its cluster's aggregates, which else would be
    sent for nearly every row. Larger clusters, of which there are few, are aggregated where their rows lie.
    """
    large = F.broadcast(df.groupBy("cluster_id").count().filter(F.col("count") > BIG).select("cluster_id"))
    return records(df.join(large, "cluster_id", "left_anti").repartition("cluster_id")).unionByName(records(df.join(large, "cluster_id", "left_semi")))


def golden(df: DataFrame) -> DataFrame:
    """One record for each cluster_id, as records() makes them."""
    return by_size(df, records)


def records(df: DataFrame) -> DataFrame:
    """One record for each cluster_id.

    df: cluster_id, row_id, portal, portal_rank, url, town, street, size, price, rooms, floor, floors_total, elevator, cert,
    year_built, lat, lng, updated_at, status, photos; address, address_ascii, project, unit_no, year_top, transaction,
    district and region where there are any.
    Newest: updated_at descending (undated rows last), portal, row; best: portal, newest, row.
    """
    own = Choice(df)
    newest, best, pick = own.newest, own.best, own.first
    both = F.col("floor").isNotNull() & F.col("floors_total").isNotNull()
    by_best = ("size", "floor", "floors_total", "cert", "year_built", "rooms", "project", "unit_no", "year_top", "transaction", "district", "region")
    by_newest = ("street", "price", "status", "address", "address_ascii")
    one = df.groupBy("cluster_id").agg(
        F.count("*").alias("cluster_size"),
        F.min_by(F.struct("portal", "url", "updated_at", *[F.col(c) if c in own.columns else F.lit(None).cast("string").alias(c) for c in ("address", "address_ascii", "town")]), newest).alias("p"),
        *[x for c in by_best for x in pick(c, c, best)],
        *[x for c in by_newest for x in pick(c, c, newest)],
        *pick("pair", F.struct("floor", "floors_total"), newest, both),
        F.min("size").alias("__lo"), F.max("size").alias("__hi"), F.median("size").alias("__mid"),
        F.min("price").alias("__plo"), F.max("price").alias("__phi"),
        *pick("elevator", "elevator", F.struct(~F.col("elevator"), F.col("row_id"))),
        F.avg("lat").alias("lat"), F.avg("lng").alias("lng"),
        (F.min("status") != F.max("status")).alias("__status_differ"), (F.min("rooms") != F.max("rooms")).alias("__rooms_differ"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("photos")))).alias("photos"),
    )
    first_row = F.struct("portal_rank", "row_id")
    out = one.join(modes(df, "rooms", newest, newest), "cluster_id", "left").join(modes(df, "town", newest, first_row), "cluster_id", "left")
    value = lambda c: F.col(f"__{c}")
    price, far = value("price"), lambda x: F.abs(x - value("price")) > 0.05 * F.greatest(F.abs(value("price")), F.lit(1.0))
    wide = F.coalesce(F.col("__hi") - F.col("__lo") > 0.05 * F.col("__hi"), F.lit(False))
    no = F.lit(False)
    flags = {
        "price_disagree": F.coalesce((price != 0) & (far(F.col("__plo")) | far(F.col("__phi"))), no),
        "rooms_disagree": F.coalesce("__rooms_differ", no),
        "size_gt_5pct": wide,
        "status_disagree": F.coalesce("__status_differ", no),
    }
    named = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))
    size = F.when(wide, value("size")).otherwise(F.col("__mid"))
    leads = F.col("rooms_mode.lead") == 1  # else several values are as frequent, and the best portal decides
    rooms, pair = F.when(leads, F.col("rooms_mode.first.v")).otherwise(value("rooms")), value("pair")
    reasons = provenance(leads, wide, F.coalesce("__rooms_differ", no))
    return out.select(
        "cluster_id", "cluster_size", F.col("p.portal").alias("primary_portal"), F.col("p.url").alias("primary_url"), F.col("p.updated_at").alias("updated_at"), value("street").alias("street"),
        F.coalesce("town_mode.first.v", "p.town").alias("town"), size.alias("size"), price.alias("price"), rooms.alias("rooms"),
        F.when(pair.isNotNull(), pair["floor"]).otherwise(value("floor")).alias("floor"), F.when(pair.isNotNull(), pair["floors_total"]).otherwise(value("floors_total")).alias("floors_total"),
        value("elevator").alias("elevator"), value("cert").alias("cert"), value("year_built").alias("year_built"), "lat", "lng", value("status").alias("status"), "photos",
        F.try_divide(price, F.nullif(size, F.lit(0.0))).alias("price_psm"), named.alias("flags"),
        *[value(c).alias(c) for c in ("address", "address_ascii", "project", "unit_no", "year_top", "transaction", "district", "region")], reasons.alias("provenance"),
    )


def provenance(leads: Column, wide: Column, differ: Column) -> Column:
    """JSON of portal, link and reason of each field that one row gave, by field name. Reads golden()'s inner columns."""
    source = lambda c: F.col(f"__{c}_from")
    best = lambda c, reason="priority": (source(c), F.lit(reason))
    pair, primary = F.col("__pair"), F.col("p")
    recent = lambda c: (source(c), F.when(primary[c].isNotNull(), "primary_recent").otherwise("fallback_non_null"))
    where = {
        "address_norm": recent("address"), "address_ascii": recent("address_ascii"),
        "address_town": (F.col("town_mode.first"), F.lit("majority")), "project_name_norm": best("project"), "unit_no": best("unit_no"),
        "size_m2": (F.when(wide, source("size")), F.lit("priority")), "price": best("price", "latest"), "status": best("status", "latest"),
        "rooms": (F.when(leads, F.struct(F.col("rooms_mode.first.portal").alias("portal"), F.col("rooms_mode.first.url").alias("url"))).otherwise(source("rooms")), F.when(leads, F.when(differ, "majority").otherwise("only_value")).otherwise("priority")),
        "floor": (F.when(pair.isNotNull(), source("pair")).otherwise(source("floor")), F.when(pair.isNotNull(), "floor_tuple").otherwise("priority")),
        "floors_total": (F.when(pair.isNotNull(), source("pair")).otherwise(source("floors_total")), F.when(pair.isNotNull(), "floor_tuple").otherwise("priority")),
        "elevator": (source("elevator"), F.when(F.col("__elevator"), "any_true").otherwise("any_false")),
        "year_of_construction": best("year_built"), "energ_cert": best("cert"), "updated_at": (primary, F.lit("primary_recent")),
    }
    given = [F.when(row["url"].isNotNull() | row["portal"].isNotNull(), F.struct(F.lit(name).alias("key"), F.struct(row["portal"].alias("portal"), row["url"].alias("source_url"), reason.alias("reason")).alias("value"))) for name, (row, reason) in sorted(where.items())]
    return F.to_json(F.map_from_entries(F.array_compact(F.array(*given))), {"ignoreNullFields": "false"})


def modes(df: DataFrame, value: str, order: Column, ties: Column) -> DataFrame:
    """cluster_id, <value>_mode: struct of the most frequent value's first row in the order (v, portal, url) and of how many values lead.

    Values as frequent as one another go by the first row in the order of `ties`.
    """
    row = F.struct(F.col(value).alias("v"), "portal", "url")
    counts = df.filter(F.col(value).isNotNull()).groupBy("cluster_id", value).agg(F.count("*").alias("n"), F.min(ties).alias("t"), F.min_by(row, order).alias("r"))
    levels = counts.groupBy("cluster_id", "n").agg(F.count("*").alias("lead"), F.min_by("r", "t").alias("first"))
    return levels.groupBy("cluster_id").agg(F.max_by(F.struct("lead", "first"), "n").alias(f"{value}_mode"))


def record_id() -> Column:
    """listing_id of a golden record, from its address, size, floors, year, project and energy class."""
    address = F.trim(F.coalesce(F.nullif("address", F.lit("")), "address_ascii"))
    return listing_id(address, numbers.one_decimal(F.col("size")), *[F.trim(F.col(c).cast("string")) for c in ("floor", "floors_total", "year_built", "project", "cert")])


def golden_table(gold: DataFrame, run_date: str) -> DataFrame:
    """Golden records as the GOLDEN table, with their listing_id."""
    return conform(
        gold.select(
            record_id().alias("listing_id"),
            F.col("town").alias("address_town"), F.col("address").alias("address_norm"), "address_ascii", F.col("project").alias("project_name_norm"), "unit_no", F.col("size").alias("size_m2"), F.rint("price").alias("price"), "price_psm",
            "rooms", "floor", "floors_total", "elevator", F.col("year_built").alias("year_of_construction"), F.col("year_top").alias("year_of_top"), F.col("cert").alias("energ_cert"), "lat", "lng", "updated_at", "status",
            "primary_portal", F.col("primary_url").alias("primary_source_url"), F.col("photos").alias("photo_fingerprints"), F.col("provenance").alias("provenance_json"), flag_json(F.col("flags")).alias("field_conflict_flags"),
            "cluster_size", F.lit(run_date).alias("run_date"),
        ),
        GOLDEN,
    )


def mean_flags(gold: DataFrame) -> DataFrame:
    """mean_flags: how many conflict flags a record has on average."""
    return gold.agg(F.avg(F.size("flags")).alias("mean_flags"))


def renumbered(df: DataFrame) -> DataFrame:
    """row_id from 0 in the order of portal_rank and row_id: numbered within ranges of that order, so no task holds all rows."""
    placed = df.repartitionByRange("portal_rank", "row_id").withColumn("__part", F.spark_partition_id())
    placed = cut(placed)  # the parts have to stay as they are
    before = placed.groupBy("__part").count().withColumn("__before", F.sum("count").over(W.orderBy("__part")) - F.col("count")).drop("count")  # a row a partition
    at = F.row_number().over(W.partitionBy("__part").orderBy("portal_rank", "row_id")) - 1
    return placed.withColumn("__at", at).join(F.broadcast(before), "__part").withColumn("row_id", F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")


def flag_json(flags: Column) -> Column:
    """The flags that are set, as a JSON object with sorted keys."""
    return F.to_json(F.map_from_entries(F.transform(F.array_sort(flags), lambda f: F.struct(f, F.lit(True)))))


def listing_id(address: Column, *parts: Column) -> Column:
    """sha1 over the address and the other parts, lower case; numbers without decimals, nulls empty."""
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in (address, *parts)]
    return F.sha1(F.lower(F.concat_ws("|", *text)).cast("binary"))


def conflict_report(gold: DataFrame) -> DataFrame:
    """cluster_id, conflict_fields, source_count of the clusters with a flag."""
    return gold.filter(F.size("flags") > 0).select("cluster_id", F.concat_ws(",", "flags").alias("conflict_fields"), F.col("cluster_size").alias("source_count"))


def with_previous(sources: DataFrame, previous: DataFrame, run_date: Column, order: str | None = None) -> DataFrame:
    """first_seen carried over from the previous run by (portal, listing_key); last_seen is the run.

    Of several rows of a key, the last in `order` counts; without an order, the earliest first_seen.
    """
    old = previous.groupBy("portal", "listing_key").agg((F.max_by("first_seen", order) if order else F.min("first_seen")).alias("__first"))
    return sources.join(old, ["portal", "listing_key"], "left").withColumns({"first_seen": F.coalesce("__first", run_date), "last_seen": run_date}).drop("__first")
