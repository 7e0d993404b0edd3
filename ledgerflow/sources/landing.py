"""Landing files: JSON feeds read with a fixed schema, a rescued-data column, and a micro-batched writer.

Layouts
-------
``array``  one JSON array of objects per file, possibly indented (the extraction client's format). Such a file is
           not splittable: one file = one task, so writers must cap records per file.
``lines``  one JSON value per line: an object, or an array of objects. Splittable; the recommended layout at scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.payload import bound

RESCUED = "_rescued_data"
# Keys of the rescued entry of a file or record that is no JSON object: its text, and the file it came from.
MALFORMED, FILE = "_malformed", "_file"


def read_landing(spark: SparkSession, path: str, schema: T.StructType, layout: str = "array",
                 stream: bool = False, **options) -> DataFrame:
    """Typed rows from landing JSON. ``array`` needs multiLine (line mode turns an indented file into null rows)."""
    reader = spark.readStream if stream else spark.read
    r = reader.schema(schema).option("mode", "PERMISSIVE")
    if layout == "array":
        r = r.option("multiLine", True)
    for k, v in options.items():
        r = r.option(k, v)
    return r.json(path)


def _as_text(field_value: Column, t: T.DataType) -> Column:
    if isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(field_value)
    return field_value.cast("string")


def _typed_map(typed: Column, schema: T.StructType) -> Column:
    return F.create_map(*[x for f in schema.fields for x in (F.lit(f.name), _as_text(typed[f.name], f.dataType))])


def _rescue(raw_map: Column, typed_map: Column, schema: T.StructType, prefix: str) -> Column:
    """Entries of ``raw_map`` the schema could not hold: unknown keys, or a non-null raw value whose typed
    value came out null (wrong type, overflow). Keys are prefixed with the parent path."""
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    kept = F.map_filter(raw_map, lambda k, v: ~F.array_contains(names, k)
                        | (v.isNotNull() & F.element_at(typed_map, k).isNull()))
    if prefix:
        kept = F.transform_keys(kept, lambda k, v: F.concat(F.lit(prefix), k))
    return kept


def _is_nested(t: T.DataType) -> bool:
    return isinstance(t, T.StructType) or isinstance(t, T.ArrayType) and _is_nested(t.elementType)


def _below(raw: Column, typed: Column, t: T.DataType, path: Column) -> Column:
    """Entries (path, text) of the JSON text ``raw`` that ``typed``, its value read as ``t``, could not hold, at any depth:
    ``path`` is ``a.b`` in structs and ``a[0].b`` in arrays. Nothing is looked for below a value that is itself null."""
    none = F.array().cast("array<struct<key:string,value:string>>")
    entry = lambda p, v: F.struct(p.alias("key"), v.alias("value"))
    if isinstance(t, T.StructType):
        def fields(m: Column) -> Column:
            own = F.map_entries(_rescue(m, _typed_map(typed, t), t, ""))
            parts = [F.transform(own, lambda e: entry(F.concat(path, F.lit("."), e["key"]), e["value"]))]
            parts += [_below(F.element_at(m, F.lit(f.name)), typed[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}")))
                      for f in t.fields if _is_nested(f.dataType)]
            return F.when(m.isNotNull() & typed.isNotNull(), F.flatten(F.array(*parts))).otherwise(none)
        return bound(F.from_json(raw, "map<string,string>"), fields)

    def elements(texts: Column) -> Column:
        def one(text: Column, i: Column) -> Column:
            at, got = F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), F.get(typed, i)
            return (F.when(text.isNotNull() & got.isNull(), F.array(entry(at, text)))
                    .otherwise(_below(text, got, t.elementType, at)))
        return F.when(texts.isNotNull() & typed.isNotNull(), F.flatten(F.transform(texts, one))).otherwise(none)
    return bound(F.from_json(raw, "array<string>"), elements)


def _attach_rescued(records: DataFrame, raw: str, file: str, schema: T.StructType, column: str) -> DataFrame:
    """Typed struct + rescued JSON for each raw record text. A text that is no JSON object gives nulls only (never half
    a record), and is rescued whole with its file.

    Staged projections: each record is parsed once (typed struct, raw key/value map) and its typed map is built
    once; the per-entry filter then only looks values up. (Referencing the parse inside the filter lambda would
    re-parse the record for every entry.)
    """
    nested = [f for f in schema.fields if isinstance(f.dataType, T.StructType)]   # one nested level
    parsed = records.select(F.from_json(F.col(raw), schema, {"mode": "PERMISSIVE"}).alias("__r"),
                            F.from_json(F.col(raw), "map<string,string>").alias("__m"), raw, file)
    bad = F.create_map(F.lit(MALFORMED), F.coalesce(raw, F.lit("null")), F.lit(FILE), F.col(file))
    parsed = parsed.select(F.when(F.col("__m").isNotNull(), F.col("__r")).alias("__r"), "__m",
                           F.when(F.col("__m").isNull(), bad).alias("__bad"))
    parsed = parsed.select("__r", "__m", "__bad", _typed_map(F.col("__r"), schema).alias("__t0"),
                           *[F.from_json(F.element_at("__m", F.lit(f.name)), "map<string,string>").alias(f"__m{i}")
                             for i, f in enumerate(nested, 1)],
                           *[_typed_map(F.col("__r")[f.name], f.dataType).alias(f"__t{i}")
                             for i, f in enumerate(nested, 1)])
    parts = [_rescue(F.col("__m"), F.col("__t0"), schema, "")]
    for i, f in enumerate(nested, 1):
        parts.append(F.coalesce(_rescue(F.col(f"__m{i}"), F.col(f"__t{i}"), f.dataType, f"{f.name}."),
                                F.create_map().cast("map<string,string>")))
    merged = F.map_concat(*parts) if len(parts) > 1 else parts[0]
    deep = [_below(F.element_at(f"__m{i}", F.lit(g.name)), F.col("__r")[f.name][g.name], g.dataType, F.lit(f"{f.name}.{g.name}"))
            for i, f in enumerate(nested, 1) for g in f.dataType.fields if _is_nested(g.dataType)]
    deep += [_below(F.element_at("__m", F.lit(f.name)), F.col("__r")[f.name], f.dataType, F.lit(f.name))
             for f in schema.fields if isinstance(f.dataType, T.ArrayType) and _is_nested(f.dataType)]
    if deep:
        merged = F.map_concat(merged, F.map_from_entries(F.flatten(F.array(*deep))))
    return parsed.select("__r", F.coalesce("__bad", merged).alias("__x")).select(
        "__r.*", F.when(F.size("__x") > 0, F.to_json("__x")).alias(column))


def with_rescued(spark: SparkSession, path: str, schema: T.StructType, layout: str = "array",
                 stream: bool = False, column: str = RESCUED, **options) -> DataFrame:
    """Typed rows plus ``column``: a JSON object of everything the schema could not hold (null when nothing).

    Covers keys at any depth, named by their path (``a.b`` in structs, ``a[0].b`` in arrays of structs). A file
    (``array``) or line (``lines``) that is cut short or no JSON, and an array element that is no object, becomes one
    row of nulls whose rescued text holds it, without white space around it, and the name of its file. Blank files and lines are nothing.
    ``options`` go to the reader, such as ``cleanSource`` and ``maxFilesPerTrigger`` of a stream.
    """
    if layout not in ("array", "lines"):
        raise ValueError(f"layout must be 'array' or 'lines', not {layout!r}")
    reader = (spark.readStream if stream else spark.read).options(**options)
    # wholetext must be an argument: as .option() it is ignored
    text = reader.text(path, wholetext=layout == "array").select("value", F.col("_metadata.file_path").alias("__file"))
    v = F.btrim("value", F.lit(" \t\r\n"))
    records = text.select(v.alias("__v"), "__file").where(F.col("__v") != "")
    listed = F.when(F.col("__v").startswith("["), F.from_json("__v", "array<string>"))
    records = records.select(F.explode(F.coalesce(listed, F.array("__v"))).alias("__raw"), "__file")
    return _attach_rescued(records, "__raw", "__file", schema, column)


# Full-precision timestamp text (Spark's JSON writer otherwise cuts to milliseconds).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_batches(df: DataFrame, path: str, max_records: int = 0, mode: str = "append") -> None:
    """Landing writer: JSON lines, one file a task, or at most ``max_records`` records per file (a remainder gets its
    own file) where a consumer needs small files.

    Timestamps keep microseconds. Records are written where they lie: no shuffle, each task writes its own files.
    """
    (df.write.mode(mode).option("maxRecordsPerFile", max_records)
     .option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_NTZ_FORMAT).json(path))
