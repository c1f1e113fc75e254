"""Dictionary, registry and guides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.order import numbered
from .playlists import RECORD_SCHEMA, enabled_sources, is_guide_payload, source_name
from .sinks import PART_DIGITS

CHANNEL_SCHEMA = "standard_name string, category string, group_title string, tvg_id string, display_name string"
BROKEN = "_broken"
REGISTRY_SCHEMA = "source_idx int, name string, url string, type string, enabled boolean, region string"
# Elements and attributes of the XMLTV format, in the order of its document type.
_TEXT = "array<struct<_lang:string,_VALUE:string>>"
_ICON = "array<struct<_src:string,_width:string,_height:string,_VALUE:string>>"
_PERSON = "array<string>"
_RATING = f"array<struct<_system:string,value:string,icon:{_ICON}>>"
CHANNEL_ELEMENT = f"struct<_id:string,`display-name`:{_TEXT},icon:{_ICON},url:array<string>>"
PROGRAMME_ELEMENT = (
    "struct<_start:string,_stop:string,`_pdc-start`:string,`_vps-start`:string,_showview:string,_videoplus:string,_channel:string,_clumpidx:string,"
    f"title:{_TEXT},`sub-title`:{_TEXT},desc:{_TEXT},"
    f"credits:struct<director:{_PERSON},actor:array<struct<_role:string,_VALUE:string>>,writer:{_PERSON},adapter:{_PERSON},producer:{_PERSON},"
    f"composer:{_PERSON},editor:{_PERSON},presenter:{_PERSON},commentator:{_PERSON},guest:{_PERSON}>,"
    f"date:string,category:{_TEXT},keyword:{_TEXT},language:{_TEXT},`orig-language`:{_TEXT},length:struct<_units:string,_VALUE:string>,"
    f"icon:{_ICON},url:array<string>,country:{_TEXT},`episode-num`:array<struct<_system:string,_VALUE:string>>,"
    "video:struct<present:string,colour:string,aspect:string,quality:string>,audio:struct<present:string,stereo:string>,"
    f"`previously-shown`:struct<_start:string,_channel:string,_VALUE:string>,premiere:{_TEXT},`last-chance`:{_TEXT},new:string,"
    f"subtitles:array<struct<_type:string,language:{_TEXT}>>,rating:{_RATING},`star-rating`:{_RATING},"
    "review:array<struct<_type:string,_source:string,_reviewer:string,_lang:string,_VALUE:string>>>"
)
GUIDE_SCHEMA = f"channel array<{CHANNEL_ELEMENT}>, programme array<{PROGRAMME_ELEMENT}>"
#: What merging needs to choose.
NARROW_SCHEMA = f"channel array<struct<_id:string,`display-name`:{_TEXT}>>, programme array<struct<_start:string,_stop:string,_channel:string,title:{_TEXT}>>"


def read_dictionary(spark: SparkSession, channels: str, aliases: str) -> tuple[DataFrame, DataFrame]:
    """Standard channels in file order (ord), and (alias, standard_name)."""
    table = spark.read.schema(CHANNEL_SCHEMA).json(channels, multiLine=True).withColumn("ord", F.monotonically_increasing_id())
    pairs = spark.read.text(aliases, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("alias", "standard_name"))
    return table, pairs


def read_conversion(spark: SparkSession, path: str) -> DataFrame:
    """(traditional, simplified) from tab-separated text: one entry a line, further fields and lines without a tab are ignored."""
    fields = F.split("value", "\t")
    rows = spark.read.text(path).select(F.try_element_at(fields, F.lit(1)).alias("traditional"), F.try_element_at(fields, F.lit(2)).alias("simplified"))
    return rows.where("traditional <> '' AND simplified IS NOT NULL")


def with_registry_defaults(registry: DataFrame) -> DataFrame:
    defaults = {"type": F.lit("m3u"), "enabled": F.lit(True), "region": F.lit("cn")}
    return registry.withColumns({c: F.coalesce(c, v) for c, v in defaults.items()})


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry from JSON lines, with defaults."""
    return with_registry_defaults(spark.read.schema(REGISTRY_SCHEMA).json(path))


def read_registry_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Registry from a settings file in block style: under `sources:`, one item a source, one `key: value` a line.

    Comments, blank lines, quotes and unknown keys are passed over; a source without name is left out. source_idx is the
    item's place from 0. The file has a few lines a source.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("at", "line")).where(~F.col("line").rlike(r"^\s*(#|$)"))
    so_far = Window.partitionBy(F.lit(1)).orderBy("at")  # a settings file is one small text
    section = F.last(F.when(F.col("line").rlike(r"^\w"), F.regexp_extract("line", r"^(\w+)\s*:", 1)), ignorenulls=True).over(so_far)
    item = F.count_if(F.col("line").rlike(r"^\s*-(\s|$)")).over(Window.partitionBy("section").orderBy("at"))
    pair = r"^[\s-]*(\w+)\s*:\s*(?:\"([^\"]*)\"|'([^']*)'|([^#]*?))\s*(?:#.*)?$"
    value = F.coalesce(*[F.nullif(F.regexp_extract("line", pair, k), F.lit("")) for k in (2, 3, 4)])
    fields = lines.withColumn("section", section).select("section", item.alias("item"), F.regexp_extract("line", pair, 1).alias("key"), value.alias("value"))
    of = lambda key: F.max(F.when(F.col("key") == key, F.col("value")))
    rows = fields.where("section = 'sources' AND item > 0").groupBy("item").agg(
        *[of(c).alias(c) for c in ("name", "url", "type")], of("enabled").cast("boolean").alias("enabled"), of("region").alias("region")
    )
    return with_registry_defaults(rows.select((F.col("item") - 1).cast("int").alias("source_idx"), "name", "url", "type", "enabled", "region").where("name IS NOT NULL"))


def list_sources(registry: DataFrame, width: int = 60) -> DataFrame:
    """Numbered listing; long addresses end in three dots."""
    url = F.when(F.length("url") < width, F.col("url")).otherwise(F.concat(F.substring("url", 1, width - 3), F.lit("...")))
    return numbered(registry, "source_idx").select(F.col("number").cast("int").alias("number"), "name", url.alias("url"), "type", "enabled", "region")


def disabled_sources(registry: DataFrame) -> DataFrame:
    off = registry.where(~F.coalesce("enabled", F.lit(True)))
    return numbered(off, "source_idx").withColumn("number", F.col("number").cast("int"))


def read_guides(documents: DataFrame, element: bool = True) -> tuple[DataFrame, DataFrame]:
    """(doc_idx, xml) -> channels (doc_idx, elem_idx, id, display_name, element) and programmes (doc_idx, elem_idx, channel,
    start, stop, title, element). `element` is the whole element with all fields of the format; without it, only the other
    columns' fields are parsed.

    Text that is no guide or does not parse gives no rows. Only direct children of the root count.
    """
    options = {"ignoreSurroundingSpaces": "false"}
    parsed = documents.where(is_guide_payload("xml")).select("doc_idx", F.from_xml("xml", GUIDE_SCHEMA if element else NARROW_SCHEMA, options).alias("tv"))
    whole = ["element"] if element else []
    # Outer: for an inner one Spark adds a filter on the array's size below it, which parses every document once more, and
    # before any join that leaves documents out.
    children = lambda tag: parsed.select("doc_idx", F.posexplode_outer(f"tv.{tag}").alias("elem_idx", "element")).where("elem_idx IS NOT NULL")
    return _channels(children("channel"), whole), _programmes(children("programme"), whole)


def _channels(rows: DataFrame, whole: list[str]) -> DataFrame:
    names = F.try_element_at(F.col("element.`display-name`._VALUE"), F.lit(1))
    return rows.select("doc_idx", "elem_idx", F.col("element._id").alias("id"), names.alias("display_name"), *whole)


def _programmes(rows: DataFrame, whole: list[str]) -> DataFrame:
    title = F.coalesce(F.try_element_at(F.col("element.title._VALUE"), F.lit(1)), F.lit(""))
    fields = [F.col(f"element._{c}").alias(c) for c in ("channel", "start", "stop")]
    return rows.select("doc_idx", "elem_idx", *fields, title.alias("title"), *whole)


def read_landed_guides(spark: SparkSession, path: str, registry: DataFrame, folders: bool = False, records: str | None = None, element: bool = True) -> tuple[DataFrame, DataFrame]:
    """Channels and programmes of landed guides of enabled sources, as read_guides gives them, element by element: Spark's
    reader streams through a file, so no such guide is ever one value. doc_idx is the source's place in the registry.

    A file that does not parse to its end gives no rows at all. Elements count wherever they lie; the format has them only
    below the root. Each of the two lists and reads the folder; where one is wanted, read_landed_channels and
    read_landed_programmes do so once.

    Files cost by their number. A landing of very many guides packs small ones: `records` is a folder of Parquet with a row
    (name, content) a guide, read by read_guides beside the files of `path`.
    """
    return read_landed_channels(spark, path, registry, folders, records, element), read_landed_programmes(spark, path, registry, folders, records, element)


def read_landed_channels(spark: SparkSession, path: str, registry: DataFrame, folders: bool = False, records: str | None = None, element: bool = True) -> DataFrame:
    files = _channels(_landed_elements(spark, path, registry, folders, "channel", CHANNEL_ELEMENT), ["element"] if element else [])
    return files if records is None else files.unionByName(read_guides(_packed(spark, records, registry), element)[0])


def read_landed_programmes(spark: SparkSession, path: str, registry: DataFrame, folders: bool = False, records: str | None = None, element: bool = True) -> DataFrame:
    files = _programmes(_landed_elements(spark, path, registry, folders, "programme", PROGRAMME_ELEMENT), ["element"] if element else [])
    return files if records is None else files.unionByName(read_guides(_packed(spark, records, registry), element)[1])


def _packed(spark: SparkSession, records: str, registry: DataFrame) -> DataFrame:
    rows = spark.read.schema(RECORD_SCHEMA).parquet(records).join(enabled_sources(registry).select("source_idx", "name"), "name")
    return rows.select(F.col("source_idx").alias("doc_idx"), F.col("content").alias("xml"))


def _landed_elements(spark: SparkSession, path: str, registry: DataFrame, folders: bool, tag: str, element: str) -> DataFrame:
    schema = StructType.fromDDL(f"x {element}")["x"].dataType
    fields = list(schema.names)  # add changes the names in place
    options = {"rowTag": tag, "columnNameOfCorruptRecord": BROKEN, "ignoreSurroundingSpaces": "false", "recursiveFileLookup": "true"}
    read = spark.read.format("xml").options(**options).schema(schema.add(BROKEN, "string")).load(path)
    read = read.select(F.struct(*[F.col(f"`{c}`") for c in fields]).alias("element"), F.col(BROKEN).isNotNull().alias("broken"), "_metadata.file_path", "_metadata.file_name", F.monotonically_increasing_id().alias("row"))
    named = read.select(source_name(folders).alias("name"), "file_path", "element", "broken", "row").join(enabled_sources(registry).select("source_idx", "name"), "name")
    own = Window.partitionBy("file_path")
    whole = named.withColumns({"elem_idx": F.row_number().over(own.orderBy("row")) - 1, "any": F.max("broken").over(own)})
    return whole.where(~F.col("any")).select(F.col("source_idx").alias("doc_idx"), "elem_idx", "element")


def read_written_guide(spark: SparkSession, path: str, element: bool = True) -> tuple[DataFrame, DataFrame]:
    """Channels and programmes of a guide that write_guide wrote, as read_guides gives them; doc_idx is the part's number.

    A part is a piece of the one document; between the root's tags it is a document of its own.
    """
    parts = spark.read.text(path, wholetext=True)
    inside = F.regexp_replace("value", r"\A(<\?xml[^>]*\?>)?\s*<tv>|</tv>\s*\z", "")
    number = F.substring("part", 2, PART_DIGITS).cast("int")
    return read_guides(parts.select(number.alias("doc_idx"), F.concat(F.lit("<tv>"), inside, F.lit("</tv>")).alias("xml")), element)
