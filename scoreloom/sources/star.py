"""Maps the star-schema test tables onto the engine's event, profile and edge tables.

Every rule is arithmetic on the given columns, so the same mapping can be written in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.numeric import pick

# Transaction and transport labels, and one place per nation key.
TRANSACTIONS = ("bankruptcy", "default", "large_transfer", "major_purchase", "regular_payment", "salary_deposit",
                "bill_payment", "savings_deposit", "large_withdrawal", "cash_advance", "loan_default",
                "atm_withdrawal", "card_payment", "online_purchase", "loan_payment")
TRANSPORTS = ("flight", "train_long_distance", "bus", "train_local", "metro", "taxi", "rideshare")
RELATIONSHIPS = ("family_event", "workplace_event", "community_event")
PLACES = (
    (0, "New York", "United States", 40.7, -74.0),
    (1, "Manchester", "United Kingdom", 53.5, -2.2),
    (2, "Munich", "Germany", 48.1, 11.6),
    (3, "Lyon", "France", 45.8, 4.8),
    (4, "Toronto", "Canada", 43.7, -79.4),
    (5, "Tokyo", "Japan", 35.7, 139.7),
    (6, "Busan", "South Korea", 35.2, 129.1),
    (7, "Queenstown", "Singapore", 1.3, 103.8),
    (8, "Rotterdam", "Netherlands", 51.9, 4.5),
    (9, "Ghent", "Belgium", 51.0, 3.7),
    (10, "Sydney", "Australia", -33.9, 151.2),
    (11, "Moscow", "Russia", 55.8, 37.6),
    (12, "Milan", "Italy", 45.5, 9.2),
    (13, "Madrid", "Spain", 40.4, -3.7),
    (14, "Recife", "Brazil", -8.1, -34.9),
    (15, "Shanghai", "China", 31.2, 121.5),
    (16, "Mumbai", "India", 19.1, 72.9),
    (17, "Maple Farm", "United States", 0.0, 0.0),
    (18, "Green Village", "France", 46.0, 2.0),
    (19, "Park Heights", "Canada", 0.0, 0.0),
    (20, "", "", 0.0, 0.0),
    (21, "Oak Grove", "Germany", 51.0, 10.0),
    (22, "Metro Center", "USA", 34.1, -118.2),
    (23, "Smallton", "Kenya", 0.0, 0.0),
    (24, "Riverton", "United Kingdom", 0.0, 0.0),
)


# Schemas of the tables read, so that no job is spent on reading footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _choose(labels: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation: city, region, country and coordinates (25 rows by construction)."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    names = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"({key}, '{city}', '{country}', {lat}D, {lon}D)" for key, city, country, lat, lon in PLACES)
        + " AS t(n_nationkey, city, country, latitude, longitude)")
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .join(F.broadcast(names), "n_nationkey")
            .select("n_nationkey", "city",
                    F.concat("r_name", F.when(F.col("n_nationkey") % 6 == 0, " Central").otherwise(""))
                    .alias("region"),
                    "country", "latitude", "longitude"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject profiles from customers."""
    key = F.col("c_custkey")
    kinds = ("vip", "regular", "student", "regular", "senior", "regular", "veteran", "regular",
             "public_servant", "regular")
    return table(spark, sf_dir, "customer").select(
        key.alias("subject_id"),
        (18 + (key * 7) % 65).cast("int").alias("age"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        (50 + (key * 137) % 900).cast("double").alias("score"),
        _choose(kinds, key % 10).alias("type"),
        F.lit("active").alias("status"),
        (key % 3 == 0).alias("is_public_official"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"))


def events(spark: SparkSession, sf_dir: str, payload: bool = True) -> DataFrame:
    """Events in the engine's flat layout. Payload keys that rules and features read are also plain columns."""
    return map_events(spark, sf_dir, spread(spark, table(spark, sf_dir, "events"), "event_id"), payload)


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with the columns ``BASE``, for jobs that add the others where they read them."""
    return base_events(spark, sf_dir, spread(spark, table(spark, sf_dir, "events"), "event_id"))


def spread(spark: SparkSession, source: DataFrame, key: str) -> DataFrame:
    """Give a source with fewer splits than cores enough partitions; anything larger is left as it is."""
    cores = spark.sparkContext.defaultParallelism
    splits = source._jdf.queryExecution().toRdd().getNumPartitions()
    return source.repartition(cores, key) if splits < cores else source


def map_events(spark: SparkSession, sf_dir: str, source: DataFrame, payload: bool = False) -> DataFrame:
    """The mapping itself, for a batch or a stream of rows of the event table."""
    located = with_details(base_events(spark, sf_dir, source)).select(*BASE[:3], *DETAILS, *BASE[6:])
    return with_payload(located) if payload else located


#: What an event is made of. All other columns of the flat layout follow from these, row by row.
BASE = ("event_id", "subject_id", "ts", "raw_type", "value", "k", "city", "region", "country", "latitude", "longitude")
DETAILS = ("event_type", "event_subtype", "source_system", "event_name", "confidence", "k", "version", "transaction_type", "transport_type",
           "amount", "severity_num", "relationship_type", "is_positive", "intensity", "requires_relationship_processing", "processed_at")


def base_events(spark: SparkSession, sf_dir: str, source: DataFrame) -> DataFrame:
    """The columns ``BASE`` of a batch or a stream of rows of the event table."""
    raw = source.select(
        "event_id", F.col("user_id").alias("subject_id"), F.col("ts").cast(T.TimestampType()).alias("ts"),
        F.col("event_type").alias("raw_type"), "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    who = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject_id"), "c_nationkey")
    return (raw.join(who, "subject_id", "left")
            .join(F.broadcast(places(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(*BASE))


def with_details(base: DataFrame) -> DataFrame:
    """Add the columns ``DETAILS``, which follow from those of ``BASE``; any other column is left as it is."""
    k, raw_type = F.col("k"), F.col("raw_type")
    kind = pick((k == 99, "identity"), (k == 97, "transportation"), (raw_type == "purchase", "financial"),
                (raw_type == "click", "social"), (raw_type == "view", "relationship"),
                (raw_type == "signup", "system"), ((k < 10) | (k >= 85), "legal"), default="civic")
    typed = base.withColumn("event_type", kind)
    et = F.col("event_type")
    subtype = pick((et == "financial", F.when(k % 10 < 7, "payment_completed").otherwise("payment_failed")),
                   (et == "social", "volunteering"), (et == "legal", "violation"),
                   (et == "system", F.when(k % 3 == 0, "data_correction").otherwise("new_citizen")),
                   (et == "relationship", _choose(RELATIONSHIPS, k % 3)), default="")
    is_rel = et == "relationship"
    return typed.withColumns({
        "event_subtype": subtype,
        "source_system": F.concat(F.lit("source_"), (F.col("event_id") % 4).cast("string")),
        "event_name": F.concat_ws("_", "event_type", "raw_type"),
        "confidence": F.lit(0.4) + (F.col("event_id") % 100) * F.lit(0.006),
        "version": F.lit(1),
        "transaction_type": _choose(TRANSACTIONS, k % 15),
        "transport_type": _choose(TRANSPORTS, F.col("event_id") % 7),
        "amount": F.col("value") * 10,
        "severity_num": k / F.lit(100.0),
        "relationship_type": F.when(is_rel, _choose(RELATIONSHIPS, k % 3)),
        "is_positive": F.when(is_rel, k % 10 < 7),
        "intensity": F.when(is_rel, k / F.lit(100.0)),
        "requires_relationship_processing": F.when(is_rel, k % 2 == 0),
        "processed_at": F.timestamp_add("MILLISECOND", k * 10, F.col("ts"))})


def with_payload(flat: DataFrame) -> DataFrame:
    """Add the JSON payload text; keys differ per event type, as on the wire."""
    et = F.col("event_type")
    note = F.concat(F.lit("note "), F.repeat(F.lit("é"), F.col("k") % 40))

    def doc(*names: str, **more: Column) -> Column:
        return F.to_json(F.struct(*names, *[v.alias(n) for n, v in more.items()]))

    payload = pick(
        (et == "financial", doc("amount", "transaction_type", processing_time=F.col("k"), memo=note)),
        (et == "transportation", doc("transport_type", distance_km=F.col("k"))),
        (et == "relationship", doc("relationship_type", "is_positive", "intensity",
                                   "requires_relationship_processing",
                                   people=F.struct((F.col("k") % 5).alias("group_size")))),
        (et == "legal", doc("severity_num", violation_type=F.lit("traffic"), fine_amount=F.col("k") * 10,
                            case_note=note)),
        (et == "system", doc(initial_age=18 + F.col("k") % 60,
                             initial_score=F.when(F.col("k") % 10 == 1, F.lit(None))
                             .otherwise(F.lit(300.0) + F.col("k") * 5),
                             citizen_type=F.when(F.col("k") % 2 == 0, "regular").otherwise("student"),
                             initial_status=F.lit("active"))),
        (et == "social", doc(activity_type=F.lit("park"), duration_hours=F.col("k") % 8,
                             participants_count=F.col("k"))),
        default="{}")
    return flat.withColumn("payload", payload)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed, typed edges between the subjects that have events; the count per subject is fixed."""
    n = table(spark, sf_dir, "events").agg(F.max("user_id") + 1).scalar()
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("u"), n.alias("n")).filter("u < n")
    u, size = F.col("u"), F.col("n")
    link = F.explode(F.array(*[
        F.struct((dst % size).alias("dst"), F.lit(rel).alias("rel"), F.lit(i).alias("i"))
        for i, (rel, dst) in enumerate((
            ("family_member", u + 1), ("family_member", u + 2), ("family_member", u + 3),
            ("friend", u * 7 + 3), ("friend", (u * u + 1)),
            ("colleague", u * 5 + 11), ("colleague", u * 3 + 7),
            ("neighbor", u + 10)))]))
    return (base.select(u.alias("src"), link.alias("e"))
            .select("src", F.col("e.dst").alias("dst"), F.col("e.rel").alias("rel"),
                    (F.lit(0.1) + (F.col("src") % 9) * F.lit(0.1)).alias("strength"),
                    F.make_date(F.lit(2020), (F.col("src") % 12 + 1).cast("int"), F.lit(1)).alias("start_date"),
                    F.when(F.col("src") % 7 == 0, F.make_date(F.lit(2024), F.lit(1), F.lit(15)))
                    .alias("end_date"))
            .filter("src <> dst").dropDuplicates(["src", "dst", "rel"]))
