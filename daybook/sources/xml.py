"""Hierarchical XML exports.

One element per object, field tags with an optional ``TYPE`` attribute, nested lists as
``X.LIST`` elements. The schema is derived from the table definitions, never inferred: which
lists occur varies from export to export.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.plans.definitions import EXTRA_FIELDS, PLAIN_LISTS, collections, source


def document_schema(collection: str, names: Collection[str] | None = None) -> T.StructType:
    """Lower-case nested schema of a collection; every leaf is text.

    A field used by a list's table is declared on every object along the path, because it may
    be given on any of them. With ``names`` it has what these tables read, and what selects documents.
    """
    tree: dict = {}

    def put(path: list[str], field: str) -> None:
        node = tree
        node.setdefault(field, None)
        for name in path:
            node = node.setdefault(name, {})
            node.setdefault(field, None)

    plain = PLAIN_LISTS.get(collection, [])
    for table in (t for t in collections()[collection] if names is None or t.name in names):
        path = table.path.split(".")[1:]
        for column in table.columns:
            field = source(table, column).lstrip(".")
            if field not in plain:
                put(path, field)
        if any(table.kind(c) == "quantity" for c in table.columns):
            put(path, "isdeemedpositive")
    for entry in EXTRA_FIELDS.get(collection, []):
        *path, field = entry.split(".")
        node = tree
        for name in path:
            node = node.setdefault(name, {})
        node[field] = None
    tree["alterid"] = None

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(name, T.StringType() if child is None else T.ArrayType(build(child)))
            for name, child in node.items()])

    schema = build(tree)
    for name in plain:
        schema = schema.add(name, T.ArrayType(T.StringType()))
    return schema


def _tag(name: str, dtype: T.DataType) -> T.StructField:
    """The element a field is read from."""
    upper = name.upper()
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        nested = T.StructType([_tag(f.name, f.dataType) for f in dtype.elementType.fields])
        return T.StructField(f"{upper}.LIST", T.ArrayType(nested))
    if isinstance(dtype, T.ArrayType):
        inner = T.StructType([T.StructField(upper, dtype)])
        return T.StructField(f"{upper}.LIST", T.ArrayType(inner))
    return T.StructField(upper, dtype)


BROKEN = "_broken"


def read_objects(spark: SparkSession, path: str, collection: str, encoding: str = "UTF-8",
                 row_tag: str | None = None, names: Collection[str] | None = None) -> DataFrame:
    """The objects of one collection, those that are no XML as their text in ``_broken`` alone.

    With ``names`` only what these tables need is taken out of an object; all of it is still read.

    UTF-8 exports are cut at the closing tags of their objects, so tasks share a large file, unless it is
    compressed: such files are read whole, one a task, and should be of bounded size.
    UTF-16LE exports without byte-order mark are read whole, with the legacy parser; land large
    ones as UTF-8.
    """
    schema = document_schema(collection, names)
    tags = T.StructType([_tag(f.name, f.dataType) for f in schema.fields])
    if "name" in schema.names:
        tags = tags.add("@NAME", T.StringType())
    tags = tags.add(BROKEN, T.StringType())
    tag = row_tag or collection.upper()
    options = {"attributePrefix": "@", "ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    if encoding.upper() == "UTF-16LE":
        raw = spark.read.format("xml").options(
            rowTag=tag, encoding=encoding, useLegacyXMLParser="true", **options).schema(tags).load(path)
    else:
        pieces = spark.read.option("lineSep", f"</{tag}>").text(path)
        # most pieces are white space and the object: nothing is searched there
        trimmed = F.ltrim("value", F.lit(" \t\r\n"))
        start = F.regexp_instr("value", F.lit(rf"<{tag}[\s>]"))
        found = F.when(trimmed.startswith(f"<{tag}>"), trimmed).otherwise(
            F.when(start > 0, F.substring("value", start, F.length("value"))))
        objects = pieces.select(found.alias("value")).where(F.col("value").isNotNull()).select(
            F.concat("value", F.lit(f"</{tag}>")).alias("value"))
        # behind a generator an object is parsed once, not again for every filter and column that reads it
        raw = objects.select(F.inline(F.array(F.from_xml("value", tags, {**options, "rowTag": tag}))))

    def column(field: T.StructField):
        tag = _tag(field.name, field.dataType).name
        c = F.col(f"`{tag}`")
        if isinstance(field.dataType, T.ArrayType) and not isinstance(
                field.dataType.elementType, T.StructType):
            c = F.flatten(F.transform(c, lambda e: e[field.name.upper()]))
        if field.name == "name":
            c = F.coalesce(c, F.col("`@NAME`"))
        return c.cast(field.dataType).alias(field.name)  # struct casts rename by position

    return raw.select(*[column(f) for f in schema.fields], BROKEN)


def read_documents(spark: SparkSession, path: str, collection: str, encoding: str = "UTF-8",
                   row_tag: str | None = None, names: Collection[str] | None = None) -> DataFrame:
    """The objects of one collection that are XML; see ``read_objects``."""
    return documents(read_objects(spark, path, collection, encoding, row_tag, names))


def documents(objects: DataFrame) -> DataFrame:
    return objects.where(F.col(BROKEN).isNull()).drop(BROKEN)


def land(spark: SparkSession, path: str, collection: str, folder: str, encoding: str = "UTF-8",
         row_tag: str | None = None) -> dict[str, int]:
    """Parse an export once and store its objects as nested Parquet below ``folder``.

    All tables of the collection are flattened from there, each reading the columns it needs.
    Returns how many objects there are and how many of them are broken, counted while writing.
    """
    seen = Observation(f"landed {collection}")
    objects = read_objects(spark, path, collection, encoding, row_tag)
    objects.observe(seen, F.count(F.lit(1)).alias("objects"), F.count(BROKEN).alias("broken")).write.mode(
        "overwrite").parquet(folder)
    return seen.get


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that ``land`` has stored."""
    return documents(spark.read.parquet(folder))


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The text of the objects that could not be parsed."""
    return spark.read.parquet(folder).where(F.col(BROKEN).isNotNull()).select(BROKEN)


def export_tag(name: str, dtype: T.DataType) -> str:
    """The element name under which a field is exported."""
    return _tag(name, dtype).name


def export_type(dtype: T.DataType) -> T.DataType:
    """``dtype`` with every nested field under its element name."""
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        return _tag("x", dtype).dataType
    return dtype


#: Objects in a file of a written export, some 40 MB of text and 2 MB on disk: a compressed file is read by one task.
OBJECTS_A_FILE = 20_000


def write_export(docs: DataFrame, path: str, collection: str, per_file: int = OBJECTS_A_FILE) -> None:
    """Documents as an export that ``read_objects`` reads: files of at most ``per_file`` objects, compressed by gzip.

    Elements repeat in every object; as plain text an export takes some twenty times the room.
    """
    tags = docs.select(*[F.col(f.name).cast(export_type(f.dataType)).alias(export_tag(f.name, f.dataType))
                         for f in docs.schema.fields])
    tags.write.format("xml").options(rootTag="ENVELOPE", rowTag=collection.upper(), compression="gzip",
                                     maxRecordsPerFile=str(per_file)).save(path)
