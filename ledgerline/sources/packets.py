"""Zipped survey and support packets: unzip in Arrow batches, everything after that in columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from datetime import date
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.aggregate import spread
from ..session import materialize
from .files import list_folders

METADATA_FILE = "metadata.yaml"
SUPPORT_FILE = "support_packet.yaml"
SURVEY_FILE = "survey_metadata.json"
ANSWERS_FILE = "responses.csv"
USER, SUBMITTED = "User ID", "Submitted At"

METADATA = "version int, type string, generated_at string, server_version string, server_id string, license_id string, customer_id string, extras struct<plugin_id:string, plugin_version:string>"
SURVEY = "id string, detractor_count int, passive_count int, promoter_count int, receipt_count int, response_count int, start_time string, duration string, questions array<struct<id:string, text:string, type:string>>"
JOB = "id string, type string, priority int, createat bigint, startat bigint, lastactivityat bigint, status string, progress int, data map<string,string>"

# Packet types, question types, job states and the fields of a support packet.
PACKET_TYPES = ["support-packet", "plugin-packet"]
QUESTION_TYPES = ["linear_scale", "text"]
JOB_STATES = ["pending", "in_progress", "success", "error", "cancel_requested", "canceled", "warning"]
REQUIRED_TEXT = [
    "server_os", "server_architecture", "server_version", "build_hash", "database_type", "database_version",
    "database_schema_version", "license_to",
]
REQUIRED_NUMBERS = [
    "websocket_connections", "master_db_connections", "read_db_connections", "license_supported_users", "active_users",
    "daily_active_users", "monthly_active_users", "inactive_user_count", "total_posts", "total_channels", "total_teams",
]
OPTIONAL_TEXT = [
    "cluster_id", "file_driver", "file_status", "ldap_vendor_name", "elastic_server_version", "elastic_server_plugins",
]
JOB_LISTS = [
    "data_retention_jobs", "bleve_post_indexing_jobs", "message_export_jobs", "elastic_post_indexing_jobs",
    "elastic_post_aggregation_jobs", "ldap_sync_jobs", "migration_jobs", "compliance_jobs",
]


#: Largest packet, and largest unpacked member, in bytes: both are held whole by one task.
MOST_BYTES, MOST_MEMBER = 64 << 20, 256 << 20
#: Packets unzipped together, packets of a reading task, files a listing and answers a reader hand on at once.
BATCH_PACKETS, PACKETS_PER_TASK, LISTED_AT_ONCE, ANSWERS_AT_ONCE = 64, 2_000, 10_000, 5_000
DATED = r"(\d{4}-\d{2}-\d{2})"


def _store(root: str):
    """Arrow's file system and the path in it: of a URI that Arrow knows (local, S3, GCS, Azure, HDFS) or of a plain local path."""
    from pyarrow import fs as pafs

    return pafs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (pafs.LocalFileSystem(), root)


def write_packets(packets: DataFrame, root: str) -> None:
    """Land ``(path, content)`` rows as files under ``root``, from tasks; a repeated attempt replaces its own files.

    Files appear under their names only when they are complete.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (store, top), made = _store(root), set()
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                folder, _, name = f"{top}/{path}".rpartition("/")
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{folder}/_{name}.part") as out:
                    out.write(content)
                store.move(f"{folder}/_{name}.part", f"{folder}/{name}")
            yield pd.DataFrame({"n": [len(batch)]})

    packets.select("path", "content").mapInPandas(write, "n long").agg(F.sum("n")).collect()


def list_packets(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.zip") -> DataFrame:
    """``(path, folder, file, length)`` of the packets under the folders, one task per folder; hidden and unfinished files are left out.

    ``path`` is cut to start at the dated folder if there is one; ``file`` is the place in the folder's store.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from fnmatch import fnmatchcase

        from pyarrow import fs as pafs

        for folder in (f for batch in batches for f in batch["folder"]):
            store, top = _store(folder)
            scheme = "file:" if isinstance(store, pafs.LocalFileSystem) else folder.partition("://")[0] + "://"
            rows = []
            for found in store.get_file_info(pafs.FileSelector(top, recursive=True)):
                hidden = any(part.startswith(("_", ".")) for part in found.path[len(top):].split("/"))
                if found.type != pafs.FileType.File or hidden or not fnmatchcase(found.base_name, pattern):
                    continue
                dated = re.search(rf"/({DATED}/.*)$", found.path)
                rows.append((dated[1] if dated else scheme + found.path, folder, found.path, found.size))
                if len(rows) == LISTED_AT_ONCE:
                    yield pd.DataFrame(rows, columns=["path", "folder", "file", "length"])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["path", "folder", "file", "length"])

    fields = "path string, folder string, file string, length long"
    if not paths:
        return spark.createDataFrame([], fields)
    folders = spark.createDataFrame(spark.sparkContext.parallelize([(p,) for p in paths], len(paths)), "folder string")
    # Written once: what lands while the packets are read belongs to the next run.
    return materialize(folders.mapInPandas(walk, fields), "packet-list")


def open_packets(listed: DataFrame, most_bytes: int = MOST_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(path, content)`` of listed packets, and ``(source, reason)`` of those too large to open.

    Sizes come from the listing: a packet that is too large is not read. Every task reads ``PACKETS_PER_TASK`` packets on average.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stores: dict = {}
        for batch in batches:
            paths, contents, held = [], [], 0
            for path, folder, file in zip(batch["path"], batch["folder"], batch["file"], strict=True):
                if folder not in stores:
                    stores[folder] = _store(folder)[0]
                with stores[folder].open_input_stream(file, compression=None) as packet:
                    paths.append(path)
                    contents.append(packet.read())
                held += len(contents[-1])
                if len(paths) == BATCH_PACKETS or held >= most_bytes:
                    yield pd.DataFrame({"path": paths, "content": contents})
                    paths, contents, held = [], [], 0
            if paths:
                yield pd.DataFrame({"path": paths, "content": contents})

    fits = spread(listed.where(F.col("length") <= most_bytes).select("path", "folder", "file"), PACKETS_PER_TASK, "path")
    return fits.mapInPandas(read, "path string, content binary"), listed.where(F.col("length") > most_bytes).select(F.col("path").alias("source"), F.lit("packet too large").alias("reason"))


def read_packets(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.zip", most_bytes: int = MOST_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(path, content)`` of the packets under the folders, and ``(source, reason)`` of those too large to open."""
    return open_packets(list_packets(spark, paths, pattern), most_bytes)


def new_folders(spark: SparkSession, root: str, target: DataFrame | None, until: date, ingested: str = "ingestion_date") -> list[str]:
    """Dated folders from the latest day of ``target`` on, up to ``until`` (exclusive); all of them for an empty target."""
    mark = None if target is None else target.agg(F.max(ingested)).first()[0]
    found = [name for name in list_folders(spark, root) if re.fullmatch(DATED, name)]
    return [f"{root}/{day}" for day in found if (mark is None or day >= str(mark)) and day < f"{until:%Y-%m-%d}"]


def resume_packets(spark: SparkSession, root: str, target: DataFrame | None, until: date, ingest: Callable[[DataFrame], tuple[DataFrame, ...]], most_bytes: int = MOST_BYTES) -> tuple[DataFrame, ...]:
    """Results of ``ingest`` over the packets that landed since the target's latest day; the last result, the rejects, holds oversized ones too.

    Rows carry their folder's day as ``ingestion_date``. Packets of the latest day that the target already has are not opened, so a
    repeated run adds nothing.
    """
    listed = list_packets(spark, new_folders(spark, root, target, until))
    if target is not None:
        done = target.select(F.col("source").alias("path")).distinct()
        listed = listed.where(F.col("length") <= most_bytes).join(done, "path", "left_anti").unionByName(listed.where(F.col("length") > most_bytes))
    packets, large = open_packets(listed, most_bytes)
    *results, rejects = ingest(packets)
    day = F.regexp_extract("source", rf"^{DATED}/", 1)
    landed = [r.withColumn("ingestion_date", day) if "ingestion_date" in r.columns else r for r in results]
    return (*landed, rejects.unionByName(large))


def _members(wanted: Sequence[str], most_member: int = MOST_MEMBER):
    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import json
        import zipfile
        import zlib

        try:
            import yaml
        except ImportError as e:
            raise ImportError("reading packets needs PyYAML on the executors") from e

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

        def text_of(packet: zipfile.ZipFile, name: str) -> str:
            # the size in the directory can lie, so reading stops by itself
            with packet.open(name) as member:
                raw = member.read(most_member + 1)
            if len(raw) > most_member:
                raise OverflowError
            text = raw.decode("utf-8")
            return json.dumps(yaml.load(text, loader), default=str) if name.endswith(".yaml") else text

        broken = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, UnicodeDecodeError, yaml.YAMLError)
        for batch in batches:
            for at in range(0, len(batch), BATCH_PACKETS):
                part, rows = batch.iloc[at : at + BATCH_PACKETS], []
                for path, content in zip(part["path"], part["content"], strict=True):
                    found: dict[str, str | None] = {name: None for name in wanted}
                    problem = None
                    try:
                        with zipfile.ZipFile(io.BytesIO(content)) as packet:
                            inside = {n.rsplit("/", 1)[-1]: n for n in packet.namelist()}
                            for name in wanted:
                                if name in inside:
                                    found[name] = text_of(packet, inside[name])
                    except OverflowError:
                        problem = "member too large"
                    except broken as e:
                        problem = f"unreadable packet: {type(e).__name__}"
                    rows.append((path, problem, *found.values()))
                yield pd.DataFrame(rows, columns=["source", "problem", *[f"f{i}" for i in range(len(wanted))]])

    return unzip


def _unzipped(packets: DataFrame, wanted: Sequence[str]) -> DataFrame:
    fields = ", ".join(["source string", "problem string", *[f"f{i} string" for i in range(len(wanted))]])
    # Written once: several results are derived from it, and unzipping is the slow part.
    return materialize(packets.select("path", "content").mapInPandas(_members(wanted), fields), "packets")


def instant(c: Column) -> Column:
    """Epoch milliseconds or a timestamp text."""
    return F.coalesce(F.timestamp_millis(c.try_cast("bigint")), F.try_to_timestamp(c)).cast("timestamp_ntz")


def metadata_problem(m: str) -> Column:
    """First broken rule of the packet metadata, NULL when all hold."""
    f = lambda name: F.col(f"{m}.{name}")
    too_long = lambda name: F.length(f(name)) > 26
    extras = f("extras").isNotNull() & (f("extras.plugin_id").isNull() | f("extras.plugin_version").isNull())
    return (
        F.when(F.col(m).isNull(), "no metadata")
        .when(f("version").isNull() | (f("version") < 1), "bad version")
        .when(f("type").isNull() | ~f("type").isin(PACKET_TYPES), "bad type")
        .when(instant(f("generated_at")).isNull(), "bad timestamp")
        .when(f("server_version").isNull(), "no server version")
        .when(f("server_id").isNull() | (F.length(f("server_id")) != 26), "bad server id")
        .when(too_long("license_id") | too_long("customer_id"), "bad license or customer id")
        .when(extras, "bad extras")
    )


def metadata_columns(m: str, server_default: str | None = None) -> list[Column]:
    f = lambda name: F.col(f"{m}.{name}")
    server = f("server_id") if server_default is None else F.coalesce(f("server_id"), F.lit(server_default))
    return [
        f("version").alias("metadata_version"), instant(f("generated_at")).alias("metadata_generated_at"),
        f("server_version").alias("metadata_server_version"), server.alias("metadata_server_id"),
        f("license_id").alias("metadata_license_id"), f("customer_id").alias("metadata_customer_id"),
    ]


def answer_rejects(answers: DataFrame, questions: Sequence[str], question: str = "question", answer: str = "answer") -> DataFrame:
    """Long answers that break a rule, with the rule."""
    unknown = ~F.col(question).isin(list(questions))
    return answers.withColumn(
        "reason", F.when(unknown, "unknown question").when(F.trim(answer) == "", "empty answer")
    ).where(F.col("reason").isNotNull())


def _long_answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import csv
    import io

    columns = ["source", "user_id", "submitted_at", "question", "answer"]
    for batch in batches:
        rows = []
        for source, text in zip(batch["source"], batch["answers"]):
            for line in csv.DictReader(io.StringIO(text, newline="")):
                user, submitted = line.pop(USER, None), line.pop(SUBMITTED, None)
                rows += [(source, user, submitted, q, a) for q, a in line.items()]
                if len(rows) >= ANSWERS_AT_ONCE:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=columns)


def ingest_survey_packets(packets: DataFrame, plugin_id: str, ingestion_date: str) -> tuple[DataFrame, DataFrame]:
    """Long answers of all valid packets with their metadata, and (source, reason) of the others.

    A packet is rejected as a whole: bad archive or metadata, another plugin, questions that differ
    between metadata and answers, unknown question types, or answers before the survey's start.
    """
    raw = _unzipped(packets, [METADATA_FILE, SURVEY_FILE, ANSWERS_FILE])
    parsed = raw.select(
        "source", "problem", F.from_json("f0", METADATA).alias("m"), F.from_json("f1", SURVEY).alias("s"), F.col("f2").alias("answers")
    )
    s = lambda name: F.col(f"s.{name}")
    counts = [s(f"{c}_count").isNull() for c in ("detractor", "passive", "promoter", "receipt", "response")]
    bad_type = F.exists(s("questions"), lambda q: q["type"].isNull() | ~q["type"].isin(QUESTION_TYPES))
    start = F.to_date(F.try_to_timestamp(s("start_time"), F.lit("d MMMM yyyy")))
    reason = F.coalesce(
        "problem", metadata_problem("m"),
        F.when(F.col("m.extras.plugin_id").isNull() | (F.col("m.extras.plugin_id") != plugin_id), "not a survey packet")
        .when(F.col("s").isNull() | s("id").isNull() | (F.length(s("id")) != 26) | reduce(lambda a, b: a | b, counts), "bad survey metadata")
        .when(F.coalesce(F.size(s("questions")), F.lit(0)) < 1, "no questions")
        .when(bad_type, "unknown question type")
        .when(start.isNull(), "bad start time")
        .when(F.col("answers").isNull(), "no answers file"),
    )
    judged = parsed.withColumns({"reason": reason, "start": start})
    good = judged.where(F.col("reason").isNull())
    long = good.select("source", "answers").mapInPandas(
        _long_answers, "source string, user_id string, submitted_at string, question string, answer string"
    )
    info = good.select("source", "m", "s", "start", F.map_from_entries(
        F.transform(s("questions"), lambda q: F.struct(q["text"], q["type"]))).alias("types"))
    answers = long.join(info, "source").select(
        "source", "user_id", F.to_date(F.try_to_timestamp("submitted_at", F.lit("d MMMM yyyy"))).alias("submitted_at"), "question",
        F.coalesce(F.nullif("answer", F.lit("")), F.lit("nan")).alias("answer"), F.col("s.id").alias("survey_id"),
        F.col("types")[F.col("question")].alias("question_type"), "m", "start", F.size("types").alias("n_types"),
    )
    # Checks over a packet's answers are plain partial aggregates per packet.
    broken = answers.groupBy("source").agg(
        F.count_if(F.col("question_type").isNull()).alias("unknown"), F.count_if(F.col("submitted_at") < F.col("start")).alias("early"),
        F.countDistinct("question").alias("asked"), F.max("n_types").alias("n_types"),
    ).withColumn(
        "reason",
        F.when(F.col("unknown") > 0, "unknown question").when(F.col("early") > 0, "answer before survey start")
        .when(F.col("asked") != F.col("n_types"), "question without answers"),
    ).where(F.col("reason").isNotNull()).select("source", "reason")
    rows = answers.join(broken.select("source"), "source", "left_anti").select(
        "user_id", "submitted_at", "question", "answer", "survey_id", "question_type", *metadata_columns("m"),
        F.col("m.extras.plugin_id").alias("metadata_extras_plugin_id"), F.col("m.extras.plugin_version").alias("metadata_extras_plugin_version"),
        "source", F.lit(ingestion_date).alias("ingestion_date"),
    )
    rejects = judged.where(F.col("reason").isNotNull()).select("source", "reason").unionByName(broken)
    return rows, rejects


def support_schema() -> T.StructType:
    texts = [f"{c} string" for c in REQUIRED_TEXT + OPTIONAL_TEXT]
    numbers = [f"{c} int" for c in REQUIRED_NUMBERS]
    jobs = [f"{c} array<struct<{', '.join(f.replace(' ', ':', 1) for f in JOB.split(', '))}>>" for c in JOB_LISTS]
    return T.StructType.fromDDL(", ".join([*texts, *numbers, "license_is_trial boolean", *jobs]))


def ingest_support_packets(packets: DataFrame, ingestion_date: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One wide row per packet, one row per job, and (source, reason) of rejected packets.

    Old packets have no metadata file; their server is ``Unknown``.
    """
    raw = _unzipped(packets, [METADATA_FILE, SUPPORT_FILE])
    parsed = raw.select(
        "source", "problem", F.from_json("f0", METADATA).alias("m"), F.col("f0").isNotNull().alias("has_metadata"),
        F.from_json("f1", support_schema()).alias("p"),
    )
    missing = reduce(lambda a, b: a | b, [F.col(f"p.{c}").isNull() for c in REQUIRED_TEXT + REQUIRED_NUMBERS])
    all_jobs = F.flatten(F.array(*[F.coalesce(F.col(f"p.{c}"), F.array().cast(support_schema()[c].dataType)) for c in JOB_LISTS]))
    bad_job = F.exists(all_jobs, lambda j: j["id"].isNull() | j["status"].isNull() | ~j["status"].isin(JOB_STATES))
    reason = F.coalesce(
        "problem", F.when(F.col("has_metadata"), metadata_problem("m")),
        F.when(F.col("p").isNull() | missing, "missing fields").when(bad_job, "bad job"),
    )
    judged = parsed.withColumn("reason", reason)
    good = judged.where(F.col("reason").isNull())
    tail = [F.col("source"), F.lit(ingestion_date).alias("ingestion_date")]
    wide = good.select(
        *[F.col(f"p.{c}") for c in REQUIRED_TEXT + REQUIRED_NUMBERS + OPTIONAL_TEXT], F.col("p.license_is_trial"),
        *metadata_columns("m", "Unknown"), *tail,
    )
    moment = lambda c: F.timestamp_millis(F.col(f"job.{c}")).cast("timestamp_ntz").alias(c)
    jobs = good.select(F.explode(all_jobs).alias("job"), *metadata_columns("m", "Unknown")[3:4], "source").select(
        "job.id", "job.type", "job.priority", moment("createat"), moment("startat"), moment("lastactivityat"), "job.status", "job.progress",
        F.to_json("job.data").alias("data"), "metadata_server_id", "source",
    )
    return wide, jobs, judged.where(F.col("reason").isNotNull()).select("source", "reason")
