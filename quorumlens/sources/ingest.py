"""Feed payloads to observations.

Every format is one DataFrame job ``(raw, sources, fetched)`` -> parsed rows.  ``raw`` holds
``source`` and ``line`` (or ``payload`` for one-document formats) and may hold ``level``.  Parsed rows
keep a ``status``: ``ok`` rows are observations, the others are counted, never silently lost.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlens.functions import addresses as A
from quorumlens.functions import constants as K
from quorumlens.functions import scoring as S
from quorumlens.functions import text as X
from quorumlens.sources.registry import dimension, expand_levels

OBSERVATION_COLUMNS = (
    *A.ADDRESS_COLUMNS,
    "source",
    "first_seen",
    "last_seen",
    "categories",
    "tags",
    "source_last_reported",
    "carried",
    "evidence_stale",
    "source_reference",
    "source_registry",
)

_BLANK = " \t\r\n\f\x0b"


def read_lines(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Text files as (source, line); compressed files by their extension."""
    return _all(
        [
            spark.read.text(path).select(F.lit(name).alias("source"), F.col("value").alias("line"))
            for name, path in paths.items()
        ]
    )


def read_registered(spark: SparkSession, registry: DataFrame, folder: str) -> DataFrame:
    """The text files of all sources in ``registry`` as (source, level, line), in one scan.

    A source's file lies at its URL below ``folder`` (a file, or a folder of part files), one for each of its levels; which
    source and level a line belongs to is told by the path it was read from.
    """
    files = expand_levels(registry).select("name", "level", "url").collect()  # the registry is small
    places = [x for f in files for x in (F.lit(f.url), F.struct(F.lit(f.name).alias("source"), F.lit(f.level).cast("int").alias("level")))]
    path = F.expr("url_decode(_metadata.file_path)")
    under = F.regexp_extract(path, f"/{re.escape(folder.strip('/'))}/(.*)$", 1)
    known = F.create_map(*places)
    place = F.coalesce(F.try_element_at(known, under), F.try_element_at(known, F.regexp_replace(under, "/[^/]*$", "")))
    rows = spark.read.text([f"{folder}/{f.url}" for f in files]).select(place.alias("_f"), F.col("value").alias("line"))
    return rows.select("_f.source", "_f.level", "line")


def read_tag_tables(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``Address,Tags`` files as (source, address, tags_text); a quoted cell may hold line breaks.

    Such a file cannot be split, so each is one task's work.
    """
    frames = [
        spark.read.schema("address string, tags_text string")
        .options(multiLine=True, escape='"', enforceSchema=True)
        .csv(path)
        .select(F.lit(name).alias("source"), "address", "tags_text")
        for name, path in paths.items()
    ]
    return _all(frames)


def read_gzipped(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Gzip text files as (source, line), and (source, error) of sources with a file that is corrupt or cut short.

    A broken file is its source's failure: no line of that source comes out, and other sources go on.  Files are inflated
    piece by piece; what is held is one compressed file and one batch of lines.
    """
    frames = [spark.read.format("binaryFile").load(path).select(F.lit(name).alias("source"), "content") for name, path in paths.items()]
    read = _all(frames).mapInArrow(_inflated, "source string, line string, error string")
    failed = read.filter("error is not null").groupBy("source").agg(F.min("error").alias("error"))
    lines = read.filter("error is null").select("source", "line")
    return lines.join(failed, "source", "left_anti"), failed


def _inflated(batches):
    def out(source, lines, error=None):
        n = len(lines)
        columns = [pa.array([source] * n, pa.string()), pa.array(lines, pa.string()), pa.array([error] * n, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["source", "line", "error"])

    for batch in batches:
        for source, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            try:
                for lines in _lines_of(memoryview(content.as_buffer())):
                    yield out(source, lines)
            except (zlib.error, EOFError) as broken:
                yield out(source, [None], str(broken) or "corrupt")


def _lines_of(data, piece: int = 1 << 16, least: int = 10_000):
    """Lists of lines of gzip ``data``, which may have several members."""
    inflate, rest, lines = zlib.decompressobj(31), b"", []
    for at in range(0, len(data), piece):
        chunk = bytes(data[at : at + piece])
        while chunk:
            rest += inflate.decompress(chunk)
            chunk = inflate.unused_data
            if inflate.eof and chunk:
                inflate = zlib.decompressobj(31)
        *whole, rest = rest.split(b"\n")
        lines += [line.decode("utf-8", "replace") for line in whole]
        if len(lines) >= least:
            yield lines
            lines = []
    if not inflate.eof:
        raise EOFError("file ends before its gzip stream does")
    if rest:
        lines.append(rest.decode("utf-8", "replace"))
    if lines:
        yield lines


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def read_payloads(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One-document files as (source, payload), one row per file."""
    return _all(
        [
            spark.read.text(path, wholetext=True).select(F.lit(name).alias("source"), F.col("value").alias("payload"))
            for name, path in paths.items()
        ]
    )


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANK))


def _no_tags() -> Column:
    return F.array().cast("array<string>")


def _content(raw: DataFrame, comments: str = "#") -> DataFrame:
    """Trimmed lines without blanks and comment lines."""
    rows = raw.withColumn("_l", stripped(F.col("line"))).filter(F.col("_l") != "")
    for mark in comments:
        rows = rows.filter(~F.startswith(F.col("_l"), F.lit(mark)))
    return rows


def _with_source(df: DataFrame, sources: DataFrame) -> DataFrame:
    dim = dimension(
        sources,
        F.col("name").alias("source"),
        F.col("categories").alias("_categories"),
        F.col("tag_only").alias("_tag_only"),
        F.col("min_score").alias("_min_score"),
    )
    return df.join(dim, "source", "left")


def _finish(df: DataFrame, fetched, **columns: Column) -> DataFrame:
    """Judge the parsed address and lay out the observation columns."""
    day = S.moment(fetched)
    defaults = {
        "first_seen": day,
        "last_seen": day,
        "categories": F.col("_categories"),
        "tags": _no_tags(),
        "source_last_reported": F.lit(None).cast("date"),
        "source_reference": F.lit(None).cast("string"),
        "source_registry": F.lit(None).cast("string"),
    }
    rejected = columns.pop("rejected", None)
    status = F.when(F.col("indicator").isNull(), "malformed").when(~A.is_global(), "non_global")
    if rejected is not None:
        status = status.when(F.col("indicator").isNotNull(), rejected)
    return df.withColumns({**defaults, **columns}).select(
        *A.ADDRESS_COLUMNS,
        "source",
        *defaults,
        F.lit(False).alias("carried"),
        F.lit(False).alias("evidence_stale"),
        F.coalesce(status, F.lit("ok")).alias("status"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """The observations among parsed rows."""
    return parsed.filter("status = 'ok'").select(*OBSERVATION_COLUMNS)


def reject_counts(parsed: DataFrame) -> DataFrame:
    """Rows per source and status; malformed and non-global stay apart."""
    return parsed.groupBy("source", "status").agg(F.count("*").alias("rows"))


# ------------------------------------------------------------------ line formats


def plain_list(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """One address or network per line; ``#`` and ``;`` start comments."""
    rows = _content(raw, "#;").withColumn("_e", F.regexp_extract("_l", r"^([^\s#;]*)", 1))
    rows = _with_source(A.with_address(rows, "_e", "entry"), sources)
    base = F.when(F.col("_tag_only"), F.col("_categories")).otherwise(_no_tags())
    if "level" in raw.columns:
        level = F.concat(F.lit(K.LEVEL_TAG_PREFIX), F.col("level").cast("string"))
        base = F.when(F.col("level").isNotNull(), F.array_append(base, level)).otherwise(base)
    return _finish(rows, fetched, tags=base)


def level_list(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """Plain list whose file names its level, kept as a tag."""
    return plain_list(raw, sources, fetched)


NETBLOCK_SCHEMA = "type string, cidr string, sblid string, rir string, copyright string, terms string"


def _ndjson(raw: DataFrame) -> DataFrame:
    return A.fence(_content(raw, "").withColumn("_j", F.from_json("_l", NETBLOCK_SCHEMA)), "_j")


def netblock_json(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """One JSON object per line: networks with the listing's reference and registry."""
    rows = _ndjson(raw).filter(F.coalesce(F.col("_j.type"), F.lit("")) != "metadata")
    rows = rows.withColumn("_e", F.col("_j.cidr"))
    rows = _with_source(A.with_address(rows, "_e", "network"), sources)
    return _finish(
        rows,
        fetched,
        source_reference=F.nullif(F.col("_j.sblid"), F.lit("")),
        source_registry=F.nullif(F.col("_j.rir"), F.lit("")),
    )


def asn_json(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """One JSON object per line about networks by number: nothing to observe."""
    return netblock_json(raw.filter(F.lit(False)), sources, fetched)


def declared_attribution(raw: DataFrame) -> DataFrame:
    """Copyright and terms a payload declares about itself: the last ones per source.

    ``raw`` needs ``ordinal``, the line number.
    """
    meta = _ndjson(raw).filter(F.col("_j.type") == "metadata")

    def last(field: str) -> Column:
        value = F.nullif(F.col(f"_j.{field}"), F.lit(""))
        newest = F.max(F.when(value.isNotNull(), F.struct("ordinal", value.alias("v"))))
        return newest.getField("v").alias(field)

    return meta.groupBy("source").agg(last("copyright"), last("terms"))


def range_list(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """``start end mask ...``: inclusive ranges of either family cut into networks.

    A line makes up to 254 networks, so lines are dealt to all tasks first, however few files or row groups they come from.
    """
    tasks = int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _content(raw.select("source", "line").repartition(tasks), "#;").withColumn("_p", F.split("_l", r"\s+"))
    whole = F.size("_p") >= 3
    rows = rows.select(
        "source",
        F.when(whole, F.get("_p", F.lit(0))).alias("_start"),
        F.when(whole, F.get("_p", F.lit(1))).alias("_end"),
    )
    return _finish(_with_source(A.with_range_networks(rows, "_start", "_end"), sources), fetched)


def dated_tab_list(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """Address, tab, ``# date``: the date is kept as the upstream's, for statistics only."""
    rows = _content(raw).withColumn("_p", F.split("_l", "\t"))
    rows = rows.withColumn("_e", stripped(F.get("_p", F.lit(0))))
    rows = _with_source(A.with_address(rows, "_e", "address"), sources)
    return _finish(rows, fetched, source_last_reported=X.reported_day(F.get("_p", F.lit(1))))


def scored_text(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """``address # level timestamp country``; a floor drops lower and unscored rows."""
    rows = _content(raw)
    at = F.instr("_l", "#")
    rest = F.when(at > 0, F.substring(F.col("_l"), at + F.lit(1), F.length("_l"))).otherwise("")
    rows = rows.withColumns(
        {
            "_e": stripped(F.substring_index("_l", "#", 1)),
            "_f": F.filter(F.split(rest, r"\s+"), lambda p: p != ""),
        }
    )
    rows = _with_source(A.with_address(rows, "_e", "address"), sources)
    first = F.get("_f", F.lit(0))
    level = F.when(first.rlike("^[0-9]+$"), first.try_cast("bigint"))
    floor = F.col("_min_score")
    below = F.when(floor.isNotNull() & (level.isNull() | (level < floor)), "below_score")
    tag = F.concat(F.lit("ipthreat-level-"), S.score_bucket(level).cast("string"))
    return _finish(
        rows,
        fetched,
        tags=F.when(level.isNotNull(), F.array(tag)).otherwise(_no_tags()),
        source_last_reported=X.reported_day(F.get("_f", F.lit(1))),
        rejected=below,
    )


def pipe_list(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """``asn | name | address | [first |] last | category``; the date is read from the end."""
    rows = _content(raw).withColumn("_p", F.transform(F.split("_l", r"\|"), stripped))
    rows = rows.withColumn("_e", F.when(F.size("_p") >= 3, F.get("_p", F.lit(2))))
    rows = _with_source(A.with_address(rows, "_e", "address"), sources)
    asn = F.get("_p", F.lit(0))
    tag = F.concat(F.lit("asn:"), asn)
    last = F.when(F.size("_p") > 3, F.try_element_at("_p", F.lit(-2)))
    return _finish(
        rows,
        fetched,
        tags=F.when(asn.rlike("^[0-9]+$"), F.array(tag)).otherwise(_no_tags()),
        source_last_reported=X.reported_day(last),
    )


def tagged_csv(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """``Address,Tags`` rows; tags name categories.

    Takes ``line``, or ``address`` and ``tags_text`` already split by Spark's CSV reader (which
    also handles quoted line breaks).
    """
    if "line" in raw.columns:
        csv = F.from_csv("line", F.lit("address string, tags_text string"))
        raw = raw.filter(stripped(F.col("line")) != "").withColumn("_c", csv).select(
            "source", "_c.address", "_c.tags_text"
        )
    rows = A.fence(raw.withColumn("_e", stripped(F.coalesce("address", F.lit("")))), "_e").filter(
        "_e <> '' and _e not like '#%' and _e <> 'Address'"
    )
    rows = _with_source(A.with_address(rows, "_e", "address"), sources)
    rows = rows.withColumn("_t", X.normalised_tags(F.coalesce("tags_text", F.lit(""))))
    found = X.tag_categories(F.col("_t"))
    return _finish(
        rows,
        fetched,
        categories=F.when(F.size(found) > 0, found).otherwise(F.col("_categories")),
        tags=F.array_sort(
            F.array_distinct(F.transform("_t", lambda t: F.concat(F.lit("turris-"), t)))
        ),
    )


# ------------------------------------------------------------------ one-document formats

IOC_SCHEMA = (
    "query_status string, data array<struct<ioc string, ioc_type string, threat_type string, "
    "malware_printable string, is_compromised string, first_seen string, last_seen string>>"
)
_ISO = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"
)


def _iso_time(text: Column) -> Column:
    return F.when(text.rlike(_ISO), text.try_cast("timestamp"))


def ioc_json(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """``{query_status, data: [{ioc: "ip:port", ...}]}`` with the upstream's own dates."""
    doc = A.fence(raw.withColumn("_j", F.from_json("payload", IOC_SCHEMA)), "_j").filter(
        "_j.query_status = 'ok'"
    )
    rows = doc.select("source", F.explode("_j.data").alias("_d")).filter(
        "_d.ioc_type = 'ip:port'"
    )
    rows = rows.withColumn("_e", X.host_of(F.coalesce("_d.ioc", F.lit(""))))
    rows = _with_source(A.with_address(rows, "_e", "address"), sources)
    first = F.coalesce(_iso_time(F.col("_d.first_seen")), S.moment(fetched))
    last = F.coalesce(_iso_time(F.col("_d.last_seen")), first)
    malware = F.nullif(F.col("_d.malware_printable"), F.lit(""))
    tags = F.array_compact(
        F.array(
            F.when(F.lower("_d.is_compromised").isin("1", "true"), F.lit(K.COMPROMISED_TAG)),
            F.concat(F.lit("malware:"), malware),
        )
    )
    return _finish(
        rows,
        fetched,
        first_seen=F.least(first, last),
        last_seen=F.greatest(first, last),
        categories=F.array(
            F.when(F.col("_d.threat_type") == "botnet_cc", "botnet-c2").otherwise(
                "malware-infrastructure"
            )
        ),
        tags=tags,
    )


CONFIDENCE_SCHEMA = (
    "errors string, data array<struct<ipAddress string, countryCode string, "
    "abuseConfidenceScore double, lastReportedAt string>>"
)


def confidence_json(raw: DataFrame, sources: DataFrame, fetched) -> DataFrame:
    """``{data: [{ipAddress, abuseConfidenceScore, ...}]}``; a payload with errors has no rows."""
    doc = A.fence(raw.withColumn("_j", F.from_json("payload", CONFIDENCE_SCHEMA)), "_j").filter(
        F.coalesce(F.col("_j.errors"), F.lit("")).isin("", "[]", "{}", "null", "false", "0")
    )
    rows = doc.select("source", F.explode("_j.data").alias("_d"))
    rows = rows.withColumn("_e", stripped(F.coalesce("_d.ipAddress", F.lit(""))))
    rows = _with_source(A.with_address(rows, "_e", "address"), sources)
    level = F.col("_d.abuseConfidenceScore")
    country = F.col("_d.countryCode")
    tags = F.array_compact(
        F.array(
            F.concat(F.lit("abuseipdb-confidence-"), S.score_bucket(level).cast("string")),
            F.when(country.rlike(r"^\p{L}{2}$"), F.concat(F.lit("cc:"), F.upper(country))),
        )
    )
    return _finish(
        rows,
        fetched,
        tags=tags,
        source_last_reported=X.reported_day(F.coalesce("_d.lastReportedAt", F.lit(""))),
    )


Job = Callable[[DataFrame, DataFrame, object], DataFrame]

# Format names a registry may use.
FORMATS: dict[str, Job] = {
    "plain_text": plain_list,
    "netset": plain_list,
    "spamhaus_json": netblock_json,
    "spamhaus_asn_json": asn_json,
    "dshield": range_list,
    "bruteforceblocker": dated_tab_list,
    "ipsum_levels": level_list,
    "threatfox_api": ioc_json,
    "turris_greylist": tagged_csv,
    "ipthreat": scored_text,
    "abuseipdb": confidence_json,
    "dataplane": pipe_list,
}


def ingest(payloads: Iterator[tuple[str, DataFrame]], sources: DataFrame, fetched) -> DataFrame:
    """Parse (format, raw) pairs into one table of parsed rows."""
    parsed = None
    for name, raw in payloads:
        part = FORMATS[name](raw, sources, fetched)
        parsed = part if parsed is None else parsed.unionByName(part)
    return parsed
