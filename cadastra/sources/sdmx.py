"""Statistics messages: observations and structure metadata as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUE = "struct<id:string,name:string,`order`:int,parent:string,start:string,`end`:string>"
DIMENSION = f"struct<id:string,name:string,keyPosition:int,`values`:array<{VALUE}>>"
MESSAGE = (
    "struct<data:struct<"
    "dataSets:array<struct<structure:int,links:array<struct<rel:string,urn:string>>,"
    "observations:map<string,array<double>>>>,"
    f"structures:array<struct<dataSets:array<int>,dimensions:struct<observation:array<{DIMENSION}>>>>>>"
)

ANNOTATIONS = "array<struct<type:string,title:string,text:string>>"
REPRESENTATION = "struct<enumeration:string,textFormat:struct<isMultiLingual:boolean,isSequence:boolean,textType:string>>"
COMPONENT = f"struct<id:string,type:string,position:int,conceptIdentity:string,localRepresentation:{REPRESENTATION}>"
ATTRIBUTE = (
    f"struct<id:string,assignmentStatus:string,conceptIdentity:string,localRepresentation:{REPRESENTATION},"
    "attributeRelationship:struct<primaryMeasure:string,dimensions:array<string>>>"
)
PERIOD = "struct<period:string,isInclusive:boolean>"
STRUCTURE = (
    "struct<data:struct<"
    "dataStructures:array<struct<id:string,version:string,name:string,dataStructureComponents:struct<"
    f"dimensionList:struct<dimensions:array<{COMPONENT}>,timeDimensions:array<{COMPONENT}>>,"
    f"measureList:struct<primaryMeasure:{COMPONENT}>,attributeList:struct<attributes:array<{ATTRIBUTE}>>>>>,"
    f"codelists:array<struct<id:string,name:string,version:string,codes:array<struct<id:string,name:string,annotations:{ANNOTATIONS}>>>>,"
    "conceptSchemes:array<struct<id:string,version:string,name:string,concepts:array<struct<id:string,name:string>>>>,"
    f"dataflows:array<struct<id:string,version:string,name:string,description:string,annotations:{ANNOTATIONS}>>,"
    "contentConstraints:array<struct<id:string,version:string,name:string,"
    "constraintAttachment:struct<dataflows:array<string>>,cubeRegions:array<struct<keyValues:array<struct<"
    f"id:string,`values`:array<string>,timeRange:struct<startPeriod:{PERIOD},endPeriod:{PERIOD}>>>>>>>>>"
)

# Fixed value: prefix of a dataflow reference.
DATAFLOW_URN = "urn:sdmx:org.sdmx.infomodel.datastructure.Dataflow=ABS:"
STAMP = "yyyy-MM-dd'T'HH:mm:ss"


def observations(messages: DataFrame, body: str, keep: list[str] | None = None) -> DataFrame:
    """One row per observation value: urn, value and the dimensions as a map id -> value struct.

    The key ``0:3:1`` of an observation gives, per dimension, the place of its
    value in the dimension's value list.
    """
    keep = keep or []
    parsed = messages.select(*keep, F.from_json(body, MESSAGE).alias("_m")).select(*keep, "_m.data.*")
    sets = parsed.select(*keep, "structures", F.inline("dataSets"))
    urn = F.filter("links", lambda l: l["rel"] == "DataStructure")[0]["urn"]
    keyed = sets.select(
        *keep,
        urn.alias("urn"),
        F.col("structures")[F.col("structure")]["dimensions"]["observation"].alias("_dims"),
        F.explode("observations").alias("_key", "_values"),
    )
    places = F.split("_key", ":")
    refs = F.transform(
        places, lambda place, i: F.get(F.col("_dims"), i)["values"][place.cast("int")]
    )
    ids = F.transform(F.slice("_dims", 1, F.size(places)), lambda d: d["id"])
    return keyed.select(
        *keep, "urn", F.map_from_arrays(ids, refs).alias("dimensions"), F.explode("_values").alias("value")
    )


def dimension_ids(df: DataFrame, names: list[str]) -> DataFrame:
    """Spread the wanted dimensions' value ids into columns."""
    rest = [c for c in df.columns if c != "dimensions"]
    return df.select(
        *rest, *[F.try_element_at("dimensions", F.lit(n))["id"].alias(n.lower()) for n in names]
    )


def _structure(messages: DataFrame, body: str, part: str) -> DataFrame:
    parsed = messages.select(F.from_json(body, STRUCTURE).alias("_m"))
    return parsed.select(F.explode(f"_m.data.{part}").alias("s"))


def _annotation(annotations: Column, kind: str, value: str) -> Column:
    """The last annotation of a kind."""
    return F.try_element_at(F.filter(annotations, lambda a: a["type"] == kind), F.lit(-1))[value]


def _representation(c: str) -> list[Column]:
    return [
        F.col(f"{c}.localRepresentation.enumeration").alias("enumeration"),
        F.col(f"{c}.localRepresentation.textFormat.textType").alias("text_type"),
        F.col(f"{c}.localRepresentation.textFormat.isMultiLingual").alias("is_multi_lingual"),
        F.col(f"{c}.localRepresentation.textFormat.isSequence").alias("is_sequence"),
    ]


def code_lists(messages: DataFrame, body: str) -> DataFrame:
    rows = _structure(messages, body, "codelists").select(
        F.col("s.id").alias("code_list"), F.col("s.version").alias("version"), F.explode("s.codes").alias("c")
    )
    return rows.select(
        "code_list",
        "version",
        F.col("c.id").alias("code"),
        F.col("c.name").alias("name"),
        _annotation(F.col("c.annotations"), "ORDER", "text").alias("code_order"),
        _annotation(F.col("c.annotations"), "FURTHER_INFORMATION", "text").alias("further_information"),
    )


def dimensions(messages: DataFrame, body: str) -> DataFrame:
    """Normal and time dimensions of every data structure."""
    lists = "s.dataStructureComponents.dimensionList"
    both = F.concat(
        F.coalesce(F.col(f"{lists}.dimensions"), F.array()), F.coalesce(F.col(f"{lists}.timeDimensions"), F.array())
    )
    rows = _structure(messages, body, "dataStructures").select(
        F.col("s.id").alias("data_structure"), F.col("s.version").alias("version"), F.explode(both).alias("d")
    )
    return rows.select(
        "data_structure", "version", F.col("d.id").alias("dimension"), F.col("d.type").alias("type"),
        F.col("d.position").alias("position"), F.col("d.conceptIdentity").alias("concept_identity"),
        *_representation("d"),
    )


def measures(messages: DataFrame, body: str) -> DataFrame:
    rows = _structure(messages, body, "dataStructures").select(
        F.col("s.id").alias("data_structure"),
        F.col("s.dataStructureComponents.measureList.primaryMeasure").alias("m"),
    )
    return rows.select(
        "data_structure", F.col("m.id").alias("measure"), F.col("m.conceptIdentity").alias("concept_identity"),
        *_representation("m"),
    )


def attributes(messages: DataFrame, body: str) -> DataFrame:
    rows = _structure(messages, body, "dataStructures").select(
        F.col("s.id").alias("data_structure"),
        F.explode("s.dataStructureComponents.attributeList.attributes").alias("a"),
    )
    return rows.select(
        "data_structure", F.col("a.id").alias("attribute"), F.col("a.assignmentStatus").alias("assignment_status"),
        F.col("a.conceptIdentity").alias("concept_identity"),
        F.col("a.attributeRelationship.primaryMeasure").alias("primary_measure"),
        F.coalesce(F.col("a.attributeRelationship.dimensions"), F.array().cast("array<string>")).alias("dimensions"),
        *_representation("a"),
    )


def concepts(messages: DataFrame, body: str) -> DataFrame:
    rows = _structure(messages, body, "conceptSchemes").select(
        F.col("s.id").alias("concept_scheme"), F.col("s.version").alias("version"), F.explode("s.concepts").alias("c")
    )
    return rows.select("concept_scheme", "version", F.col("c.id").alias("concept"), F.col("c.name").alias("name"))


def dataflows(messages: DataFrame, body: str) -> DataFrame:
    """Dataflows with default parameters (map) and layout columns (arrays)."""
    rows = _structure(messages, body, "dataflows")

    def layout(kind: str) -> Column:
        text = _annotation(F.col("s.annotations"), kind, "title")
        none = F.array().cast("array<string>")
        return F.when(text.isNull() | (text == ""), none).otherwise(F.split(text, ","))

    default = _annotation(F.col("s.annotations"), "DEFAULT", "title")
    return rows.select(
        F.col("s.id").alias("dataflow"), F.col("s.version").alias("version"), F.col("s.name").alias("name"),
        F.col("s.description").alias("description"),
        F.str_to_map(default, F.lit(","), F.lit("=")).alias("default_parameters"),
        layout("LAYOUT_COLUMN").alias("layout_column"), layout("LAYOUT_ROW").alias("layout_row"),
        layout("LAYOUT_ROW_SECTION").alias("layout_row_section"),
        F.concat(F.lit(DATAFLOW_URN), F.col("s.id"), F.lit("("), F.col("s.version"), F.lit(")")).alias("urn"),
    )


def content_constraints(messages: DataFrame, body: str) -> DataFrame:
    """One row per constrained dimension: allowed values, or a time range; ``dataflows`` are the targets."""
    rows = _structure(messages, body, "contentConstraints").select(
        F.col("s.id").alias("constraint"), F.col("s.version").alias("version"),
        F.col("s.constraintAttachment.dataflows").alias("dataflows"),
        F.explode(F.flatten(F.transform("s.cubeRegions", lambda r: r["keyValues"]))).alias("k"),
    )
    return rows.select(
        "constraint", "version", "dataflows", F.col("k.id").alias("dimension"), F.col("k.values").alias("allowed"),
        F.try_to_timestamp(F.col("k.timeRange.startPeriod.period"), F.lit(STAMP)).alias("time_from"),
        F.col("k.timeRange.startPeriod.isInclusive").alias("from_inclusive"),
        F.try_to_timestamp(F.col("k.timeRange.endPeriod.period"), F.lit(STAMP)).alias("time_to"),
        F.col("k.timeRange.endPeriod.isInclusive").alias("to_inclusive"),
    )
