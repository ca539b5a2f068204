"""Catalog and schema operators: object listing, summaries, describes, quota
usage, typed DDL and extract URLs from describe documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtable.sources.tables import TABLES, load_many

FIELD = T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType())])
FIELDS = T.ArrayType(FIELD)

# Describe field type -> DDL column type (compared ignoring case);
# any other type is VARCHAR, and the last field is always VARCHAR.
DDL_TYPES = {"id": "VARCHAR PRIMARY KEY", "string": "VARCHAR", "picklist": "VARCHAR[]",
             "currency": "DOUBLE", "double": "DOUBLE"}
DDL_DEFAULT = "VARCHAR"
DDL_LAST = "VARCHAR"
# The extract URL layout.
EXTRACT_PATH = "/services/data/v36.0/queryAll/?q="
EXTRACT_TS = "SYSTEMMODSTAMP"


def describe_object(df: DataFrame, name: str) -> DataFrame:
    """All fields of one object: object, ordinal (1-based), name, type, n_rows,
    n_null and nullable (whether a row has no value there). One aggregate over
    the table counts every column."""
    counts = [F.count(F.col(f"`{c}`")) for c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*counts).alias("n_set"))
    fields = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
                       for f in df.schema.fields])
    each = one.select("n_rows", "n_set", F.posexplode(fields).alias("i", "f"))
    n_null = F.col("n_rows") - F.get("n_set", F.col("i"))
    return each.select(F.lit(name).alias("object"), (F.col("i") + 1).alias("ordinal"), F.col("f.name").alias("name"),
                       F.col("f.type").alias("type"), "n_rows", n_null.alias("n_null"), (n_null > 0).alias("nullable"))


def describe_objects(spark: SparkSession, objects: dict[str, DataFrame]) -> DataFrame:
    """``describe_object`` of many objects in one keyed aggregate over the union
    of their scans: each row tells which of its fields (by number) have a
    value, and partial sums go into one exchange. A zero row per object keeps
    empty ones."""
    width = max((len(df.columns) for df in objects.values()), default=0)

    def flags(n_rows: int, columns: list[Column]) -> list[Column]:
        padded = columns + [F.lit(0)] * (width - len(columns))
        return [F.lit(n_rows).cast("long").alias("n_rows"), *[c.cast("long").alias(f"set{i}") for i, c in enumerate(padded)]]

    parts = []
    for name, df in objects.items():
        has = [F.col(f"`{c}`").isNotNull().cast("int") for c in df.columns]
        parts.append(df.select(F.lit(name).alias("object"), *flags(1, has)))
    parts.append(spark.createDataFrame([(n,) for n in objects], "object string").select("object", *flags(0, [])))
    sums = reduce(DataFrame.unionAll, parts).groupBy("object").agg(
        F.sum("n_rows").alias("n_rows"), F.array(*[F.sum(f"set{i}") for i in range(width)]).alias("n_set"))
    fields = F.create_map(*[x for name, df in objects.items() for x in (F.lit(name), F.array(*[
        F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema.fields]))])
    each = sums.select("object", "n_rows", "n_set", F.posexplode(fields[F.col("object")]).alias("i", "f"))
    n_null = F.col("n_rows") - F.get("n_set", F.col("i"))
    return each.select("object", (F.col("i") + 1).alias("ordinal"), F.col("f.name").alias("name"),
                       F.col("f.type").alias("type"), "n_rows", n_null.alias("n_null"), (n_null > 0).alias("nullable"))


def object_summary(df: DataFrame, name: str) -> DataFrame:
    """Basic metadata of one object: name, number of fields, field names, number of rows."""
    names = ",".join(df.schema.fieldNames())
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("object"), F.lit(len(df.columns)).cast("long").alias("n_fields"),
        F.lit(names).alias("field_names"), "n_rows")


def list_objects(spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES) -> DataFrame:
    """One row per available table: name, number of fields, number of rows.

    All tables are counted in one aggregate over the union of their scans (no
    column is read; one exchange); a zero row per table keeps empty tables."""
    frames = load_many(spark, sf_dir, names)
    scans = [df.select(F.lit(n).alias("object"), F.lit(len(df.columns)).cast("long").alias("n_fields"),
                       F.lit(1).cast("long").alias("_one")) for n, df in frames.items()]
    zeros = spark.createDataFrame([(n, len(df.columns), 0) for n, df in frames.items()],
                                  "object string, n_fields bigint, _one bigint")
    every = reduce(DataFrame.unionByName, scans + [zeros])
    return every.groupBy("object", "n_fields").agg(F.sum("_one").alias("n_rows"))


def quota_usage(df: DataFrame, scope_col: str, limits_df: DataFrame, limit_scope: str = "scope",
                limit_max: str = "max") -> DataFrame:
    """Per scope: configured maximum, rows used, remaining (null without a limit).
    Usage is a partial aggregate; scopes with a limit but no use show 0 used."""
    used = df.groupBy(F.col(scope_col).alias("scope")).agg(F.count(F.lit(1)).alias("used"))
    limits = limits_df.select(F.col(limit_scope).alias("scope"), F.col(limit_max).cast("long").alias("max_allowed"))
    joined = limits.join(used, "scope", "full_outer")
    used_c = F.coalesce(F.col("used"), F.lit(0)).cast("long")
    return joined.select("scope", "max_allowed", used_c.alias("used"),
                         (F.col("max_allowed") - used_c).alias("remaining"))


def parse_fields(doc: Column) -> Column:
    """Describe JSON → array<struct<name,type>>; accepts a bare array of fields
    or an object with a ``fields`` array."""
    obj = T.StructType([T.StructField("fields", FIELDS)])
    return F.when(F.ltrim(doc).startswith("["), F.from_json(doc, FIELDS)).otherwise(F.from_json(doc, obj)["fields"])


def _ddl_type(t: Column) -> Column:
    lt = F.lower(t)
    expr = None
    for k, v in DDL_TYPES.items():
        expr = F.when(lt == k, F.lit(v)) if expr is None else expr.when(lt == k, F.lit(v))
    return expr.otherwise(F.lit(DDL_DEFAULT))


def typed_ddl(describes_df: DataFrame, schema: str = "SALESFORCE", name_col: str = "sobject_name",
              fields_col: str = "fields_json") -> DataFrame:
    """``CREATE TABLE <schema>.<name>(f TYPE,…,last VARCHAR)`` per describe document.

    An empty, unparsable or nameless field list routes ``failure`` (ddl null).
    """
    fields = parse_fields(F.col(fields_col))
    n = F.size(fields)
    head = F.transform(F.slice(fields, 1, F.greatest(n - 1, F.lit(0))),
                       lambda f: F.concat(f["name"], F.lit(" "), _ddl_type(f["type"])))
    last = F.concat(F.element_at(fields, -1)["name"], F.lit(" " + DDL_LAST))
    body = F.array_join(F.concat(head, F.array(last)), ",")
    ddl = F.concat(F.lit(f"CREATE TABLE {schema}."), F.col(name_col), F.lit("("), body, F.lit(")"))
    ok = fields.isNotNull() & (n > 0) & F.forall(fields, lambda f: f["name"].isNotNull())
    return describes_df.select(
        F.col(name_col), F.when(ok, ddl).alias("ddl"),
        F.when(ok, F.lit("success")).otherwise(F.lit("failure")).alias("route"))


def typed_schema(fields: Sequence[tuple[str, str]]) -> T.StructType:
    """Spark schema for extracted rows from ``(name, describe type)`` pairs."""
    mapping = {"id": T.StringType(), "string": T.StringType(), "picklist": T.ArrayType(T.StringType()),
               "currency": T.DoubleType(), "double": T.DoubleType()}
    return T.StructType([T.StructField(n, mapping.get(t.lower(), T.StringType()), t.lower() != "id")
                         for n, t in fields])


def typed_extract(df: DataFrame, content_col: str, fields: Sequence[tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """JSON rows as typed columns: ``keep``, one column per described field
    (``typed_schema``), ``route`` and ``bad_record``.

    A text that is no JSON object, a value that does not fit its field's type
    and a row without its id route ``failure`` with the whole text as
    ``bad_record``; every other field of such a row is null. Fields that the
    text does not mention are null; fields that are not described are left out.
    """
    bad = "_bad_record"
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in typed_schema(fields).fields], T.StructField(bad, T.StringType())])
    row = F.from_json(F.col(content_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    out = df.select(*[F.col(c) for c in keep], F.col(content_col).alias("_content"), row.alias("_row"))
    ids = [F.col("_row").getField(n).isNotNull() for n, t in fields if t.lower() == "id"]
    ok = F.col("_row").isNotNull() & F.col("_row").getField(bad).isNull()
    for present in ids:
        ok = ok & present
    ok = F.coalesce(ok, F.lit(False))
    return out.select(*keep, *[F.when(ok, F.col("_row").getField(n)).alias(n) for n, _ in fields],
                      F.when(ok, F.lit("success")).otherwise(F.lit("failure")).alias("route"),
                      F.when(~ok, F.col("_content")).alias("bad_record"))


def build_extract_url(describes_df: DataFrame, base: str, table: str | Column, last_sync: str,
                      name_col: str = "sobject_name", fields_col: str = "fields_json",
                      encode_query: bool = False) -> DataFrame:
    """Extract URL per describe: ``base + path + SELECT f,… FROM table WHERE
    ts > last order by ts asc`` with every space turned into ``+``. ``table``
    is a fixed name or a column (e.g. the described object's own name).
    ``encode_query`` percent-encodes the query text (only the query, never the
    whole URL); spaces still become ``+``."""
    fields = parse_fields(F.col(fields_col))
    names = F.array_join(F.transform(fields, lambda f: f["name"]), ",")
    tbl = table if isinstance(table, Column) else F.lit(table)
    soql = F.concat(F.lit("SELECT "), names, F.lit(" FROM "), tbl,
                    F.lit(f" WHERE {EXTRACT_TS} > {last_sync} order by {EXTRACT_TS} asc"))
    query_text = F.url_encode(soql) if encode_query else F.replace(soql, F.lit(" "), F.lit("+"))
    ok = fields.isNotNull() & (F.size(fields) > 0)
    return describes_df.select(
        F.col(name_col), F.when(ok, F.concat(F.lit(base + EXTRACT_PATH), query_text)).alias("url"),
        F.when(ok, F.lit("success")).otherwise(F.lit("failure")).alias("route"))
