"""Evidence bundles: JSON documents and CSV snapshots, validated field by field.

A folder of bundles is read as one row per document and exploded into sections.
Every field is judged by a column expression on the JSON value itself, so that a
boolean never passes for an integer. A bundle with any problem is refused whole;
its problems are listed, one row each.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.functions.exprs import normalized_state
from plumbline.session import work_dir

# The field contract of evidence version 1.
MAX_INT, MAX_LONG = 2**31 - 1, 2**63 - 1
PROVIDERS = ("Fabric", "ADF", "OneLake")
DATASETS = ("source", "bronze", "silver", "target")
DOCUMENT_FIELDS = (
    "version", "provider", "resource_id", "as_of", "batch_no", "steps", "runs", "activities", "datasets", "schema",
    "manifest", "references",
)
REQUIRED_DOCUMENT_FIELDS = ("version", "provider", "as_of")
ISO_WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:\d{2})$"
MONEY_PATTERN = r"^-?[0-9]{1,12}([.][0-9]{1,2})?$"
CSV_INTEGER = "^[0-9]{1,19}$"
CSV_FIELDS = ("dataset", "order_id", "customer_id", "amount", "updated_at", "event_id", "batch_no", "run_id")
CONTRACT_KIND = "foundations"
CONTRACT_IDS = ("standard", "shifted", "zero")
CONTRACT_DOCUMENT_FIELDS = (
    "version", "kind", "lab_id", "contract_id", "provider", "resource_id", "as_of", "batch_no", "runs", "steps", "datasets",
)
CONTRACT_LESSONS = {
    "lab_031_databricks_classification": ("Databricks", ("db_source", "db_publication")),
    "lab_032_databricks_versions": ("Databricks", ("db_before", "db_incoming", "db_after")),
    "lab_033_synapse_publication": ("Synapse", ("sy_staging", "sy_dimension", "sy_fact")),
    "lab_034_synapse_grain": ("Synapse", ("sy_staging", "sy_dimension", "sy_fact", "sy_report")),
    "lab_035_azure_manifest": ("Azure", ("az_files",)),
    "lab_036_azure_access": ("Azure", ("az_access",)),
}


@dataclass(frozen=True)
class Field:
    kind: str
    required: bool = True
    nullable: bool = False
    maximum: int = MAX_LONG


@dataclass(frozen=True)
class Section:
    path: str
    fields: dict[str, Field]


_TEXT, _TEXT_NULL = Field("text"), Field("text", nullable=True)
_TEXT_OPTIONAL = Field("text", required=False, nullable=True)
_INT, _INT_OPTIONAL = Field("integer"), Field("integer", required=False, nullable=True)
_TIME, _TIME_OPTIONAL = Field("timestamp"), Field("timestamp", required=False, nullable=True)

RECORD = {
    "order_id": _INT, "customer_id": _INT, "amount": Field("money", nullable=True), "updated_at": _TIME,
    "event_id": _INT, "batch_no": _INT, "run_id": _TEXT,
}
RUNS = Section("runs", {
    "run_id": _TEXT, "execution_status": _TEXT_OPTIONAL, "started_at": _TIME_OPTIONAL, "ended_at": _TIME_OPTIONAL,
})
STEPS = Section("steps", {
    "step_no": Field("integer", maximum=MAX_INT), "operation": _TEXT, "run_id": _TEXT, "execution_status": _TEXT_NULL,
    "batch_no": Field("integer", nullable=True, maximum=MAX_INT), "target_rows": Field("integer", nullable=True),
    "watermark": Field("timestamp", nullable=True),
})
SECTIONS = (
    RUNS,
    Section("activities", {
        "activity_id": _TEXT, "run_id": _TEXT, "dependency_id": _TEXT_OPTIONAL, "execution_status": _TEXT_OPTIONAL,
        "source_dataset": Field("dataset", required=False, nullable=True),
        "target_dataset": Field("dataset", required=False, nullable=True),
        "rows_read": _INT_OPTIONAL, "rows_written": _INT_OPTIONAL,
    }),
    *(Section(f"datasets.{name}", RECORD) for name in DATASETS),
    Section("schema", {"dataset": Field("dataset"), "column_name": _TEXT, "data_type": _TEXT}),
    Section("manifest", {
        "partition_key": _TEXT, "file_key": _TEXT, "row_count": _INT_OPTIONAL, "snapshot_at": _TIME_OPTIONAL, "run_id": _TEXT,
    }),
    Section("references", {
        "dataset_id": _TEXT, "reference_id": _TEXT, "observed_at": _TIME_OPTIONAL, "run_id": _TEXT,
    }),
    STEPS,
)
UNIQUE_FIELDS = {"runs": "run_id", "steps": "step_no"}


def _value(item: Column, path: str) -> Column:
    return F.variant_get(item, f"$.{path}", "variant")


def _type(item: Column, path: str) -> Column:
    return F.schema_of_variant(_value(item, path))


def _text(item: Column, path: str) -> Column:
    return F.try_variant_get(item, f"$.{path}", "string")


def _value_ok(kind: Column, found: Column, text: Column, number: Column, maximum: Column) -> Column:
    """Whether a JSON value of type ``found`` is of the wanted kind."""
    is_text = found == "STRING"
    dated = text.rlike(ISO_WITH_OFFSET) & (F.length(text) <= 40) & text.try_cast("timestamp").isNotNull()
    ok = (
        F.when(kind == "integer", (found == "BIGINT") & number.between(F.lit(0), maximum))
        .when(kind == "text", is_text & F.length(text).between(1, 128) & ~text.rlike(r"[\x00-\x1f]"))
        .when(kind == "timestamp", is_text & dated)
        .when(kind == "date", is_text & text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull())
        .when(kind == "money", is_text & text.rlike(MONEY_PATTERN))
        .when(kind == "dataset", is_text & text.isin(*DATASETS))
    )
    return F.coalesce(ok, F.lit(False))


def object_problems(item: Column, fields: dict[str, Field]) -> Column:
    """Reasons why an object is refused: its shape, absent, unknown, null and ill-typed fields.

    One expression judges every entry against a map of rules, so the plan does not
    grow with the number of fields.
    """
    rules = F.create_map(*[
        x for name, f in fields.items()
        for x in (F.lit(name), F.struct(F.lit(f.kind).alias("kind"), F.lit(f.nullable).alias("nullable"),
                                        F.lit(f.maximum).cast("bigint").alias("maximum")))
    ])
    required = F.array(*[F.lit(n) for n, f in fields.items() if f.required]).cast("array<string>")
    members = F.try_variant_get(item, "$", "map<string,variant>")

    def judged(entry: Column) -> Column:
        rule, value = rules[entry["key"]], entry["value"]
        found = F.schema_of_variant(value)
        ok = _value_ok(
            rule["kind"], found, F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "bigint"), rule["maximum"])
        return (
            F.when(rule.isNull(), F.lit("unknown field"))
            .when(value.isNull() | (found == "VOID"),
                  F.when(~rule["nullable"], F.concat(F.lit("null field: "), entry["key"])))
            .when(~ok, F.concat(F.lit("invalid "), rule["kind"], F.lit(": "), entry["key"]))
        )

    absent = F.transform(F.array_except(required, F.map_keys(members)), lambda f: F.concat(F.lit("missing field: "), f))
    listed = F.concat(F.array_compact(F.transform(F.map_entries(members), judged)), absent)
    return F.when(members.isNull() | ~_is_object(item), F.array(F.lit("not an object"))).otherwise(listed)


def _is_object(item: Column) -> Column:
    return F.schema_of_variant(item).startswith("OBJECT")


def _keys(item: Column) -> Column:
    return F.map_keys(F.try_variant_get(item, "$", "map<string,variant>"))


def unknown_field_problem(item: Column, allowed) -> Column:
    extra = F.size(F.array_except(_keys(item), F.array(*[F.lit(a) for a in allowed]))) > 0
    return F.when(~_is_object(item), F.lit("not an object")).when(extra, F.lit("unknown field"))


def typed(item: Column, path: str, rule: Field) -> Column:
    if rule.kind == "integer":
        return F.try_variant_get(item, f"$.{path}", "bigint")
    cast = {"timestamp": "timestamp", "date": "date", "money": schemas.MONEY}.get(rule.kind)
    text = _text(item, path)
    return text.try_cast(cast) if cast else text


class Sections(Mapping):
    """Rows per section, each put together when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, path: str) -> DataFrame:
        if path not in self._made:
            self._made[path] = self._builders[path]()
        return self._made[path]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


@dataclass
class Evidence:
    """Accepted documents and rows per section, and the problems of refused bundles."""

    documents: DataFrame
    sections: Mapping[str, DataFrame] = field(default_factory=dict)
    problems: DataFrame | None = None
    run_sections: tuple[Section, ...] = ()


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: bundle (its path), content and SHA-256."""
    files = spark.read.text(path, wholetext=True)
    return with_hash(files.select(F.input_file_name().alias("bundle"), F.col("value").alias("content")))


def with_hash(documents: DataFrame) -> DataFrame:
    return documents.withColumn("sha256", F.sha2("content", 256))


def _located(section: str, position: Column | None, reasons: Column) -> Column:
    """Reasons, each with its place."""
    place = F.lit(None).cast("int") if position is None else position
    return F.transform(
        F.array_compact(reasons),
        lambda r: F.struct(F.lit(section).alias("section"), place.alias("pos"), r.alias("reason")),
    )


def _items(section: Section) -> Column:
    return F.try_variant_get("document", f"$.{section.path}", "array<variant>")


# Header fields with a simple kind; the sections are judged on their own.
_HEADER = {
    "resource_id": _TEXT_OPTIONAL, "as_of": _TIME_OPTIONAL,
    "batch_no": Field("integer", required=False, nullable=True, maximum=MAX_INT),
}


def _document_problems(allowed, required, extra: list[Column]) -> Column:
    document = F.col("document")
    header = F.map_filter(
        F.try_variant_get(document, "$", "map<string,variant>"), lambda k, _: k.isin(*_HEADER)
    )
    stated = F.coalesce(object_problems(F.to_variant_object(header), _HEADER), F.array().cast("array<string>"))
    shape = F.array(
        F.when(document.isNull(), F.lit("invalid JSON")),
        unknown_field_problem(document, allowed),
        *[F.when(_type(document, f).isNull(), F.lit(f"missing field: {f}")) for f in required],
        F.when(
            F.coalesce(_type(document, "version") != "BIGINT", F.lit(True))
            | (F.try_variant_get(document, "$.version", "bigint") != 1), F.lit("unsupported version")),
        *extra,
    )
    return _located("document", None, F.when(document.isNull(), shape).otherwise(F.concat(shape, stated)))


def _section_problems(section: Section) -> list[Column]:
    """Problems of a section as a whole and of each of its items."""
    items, array_type = _items(section), _type(F.col("document"), section.path)
    shape = [
        F.when(array_type.isNotNull() & ~array_type.startswith("ARRAY"), F.lit(f"not an array: {section.path}")),
    ]
    unique = UNIQUE_FIELDS.get(section.path)
    if unique:
        ids = F.array_compact(F.transform(items, lambda x: _text(x, unique)))
        shape.append(F.when(F.size(F.array_distinct(ids)) < F.size(ids), F.lit(f"repeated {unique}")))

    def judged(item: Column, position: Column) -> Column:
        return _located(section.path, position, object_problems(item, section.fields))

    none = F.array().cast("array<struct<section:string,pos:int,reason:string>>")
    return [_located(section.path, None, F.array(*shape)), F.coalesce(F.flatten(F.transform(items, judged)), none)]


def _judge(documents: DataFrame, sections, allowed, required, extra: list[Column], finish: Callable) -> Evidence:
    """Judge every document within its own row, whatever its size; bundles too large for a cell come as record lines."""
    found = [_document_problems(allowed, required, extra)]
    for section in sections:
        found += _section_problems(section)
    parsed = documents.withColumn("document", F.try_parse_json("content"))
    judged = parsed.withColumn("problems", F.concat(*found))
    accepted = judged.where(F.size("problems") == 0).drop("problems")
    problems = judged.select("bundle", F.explode("problems").alias("p")).select("bundle", "p.*")

    def rows(section: Section) -> DataFrame:
        return finish(section, accepted.select("bundle", F.posexplode(_items(section)).alias("pos", "item")))

    return Evidence(
        accepted, Sections({s.path: partial(rows, s) for s in sections}), problems,
        tuple(s for s in sections if "run_id" in s.fields),
    )


def _typed_rows(section: Section, items: DataFrame) -> DataFrame:
    item = F.col("item")
    columns = []
    for name, rule in section.fields.items():
        value = typed(item, name, rule)
        columns.append((normalized_state(value) if name == "execution_status" else value).alias(name))
    raw = [F.to_json(item).alias("raw_evidence")] if section.path in ("runs", "activities") else []
    return items.select("bundle", "pos", *columns, *raw)


def parse_bundles(documents: DataFrame) -> Evidence:
    """Validate and type a set of JSON bundles (columns ``bundle`` and ``content``).

    A name used twice in one object makes the document invalid JSON, as NaN does.
    """
    document = F.col("document")
    provider = F.when(
        ~F.coalesce((_type(document, "provider") == "STRING") & _text(document, "provider").isin(*PROVIDERS), F.lit(False)),
        F.lit("unsupported provider"))
    datasets = _value(document, "datasets")
    unknown = F.when(_type(document, "datasets").isNotNull(), unknown_field_problem(datasets, DATASETS))
    return _judge(documents, SECTIONS, DOCUMENT_FIELDS, REQUIRED_DOCUMENT_FIELDS, [provider, unknown], _typed_rows)


def _column_rule(name: str, spark_type: str) -> Field:
    kind = {"bigint": "integer", "timestamp": "timestamp", "date": "date", schemas.MONEY: "money"}.get(spark_type, "text")
    return Field(kind, required=True, nullable=name != "run_id")


def contract_sections(lesson: str) -> tuple[Section, ...]:
    """Sections of contract evidence; contract tables are never among them."""
    observed = CONTRACT_LESSONS[lesson][1]
    tables = tuple(
        Section(f"datasets.{t}", {f.name: _column_rule(f.name, f.dataType.simpleString()) for f in schemas.struct(t)})
        for t in observed
    )
    return (*tables, RUNS, STEPS)


def parse_contract_bundles(documents: DataFrame, lesson: str) -> Evidence:
    """Validate contract evidence of one lesson; truth tables in it are refused."""
    provider_name, observed = CONTRACT_LESSONS[lesson]
    document = F.col("document")

    def equals(path: str, *values: str) -> Column:
        return F.coalesce((_type(document, path) == "STRING") & _text(document, path).isin(*values), F.lit(False))

    datasets = _value(document, "datasets")
    wrong = [
        F.when(~equals("kind", CONTRACT_KIND), F.lit("unsupported kind")),
        F.when(~equals("lab_id", lesson), F.lit("another lesson")),
        F.when(~equals("contract_id", *CONTRACT_IDS), F.lit("unknown contract")),
        F.when(~equals("provider", provider_name), F.lit("unsupported provider")),
        unknown_field_problem(datasets, observed),
        *[F.when(_type(document, f"datasets.{t}").isNull(), F.lit(f"missing field: datasets.{t}")) for t in observed],
    ]
    sections = contract_sections(lesson)
    return _judge(documents, sections, CONTRACT_DOCUMENT_FIELDS, CONTRACT_DOCUMENT_FIELDS, wrong, _typed_rows)


def read_csv_snapshots(spark: SparkSession, path: str) -> Evidence:
    """Snapshot rows from CSV files with the exact header; rows with a problem are listed.

    A CSV carries neither batch nor clock, so those stay unknown until stated.
    """
    ddl = ", ".join(f"{c} string" for c in CSV_FIELDS)
    raw = (
        spark.read.schema(f"{ddl}, _corrupt_record string")
        .option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path)
        .withColumn("bundle", F.input_file_name())
    )
    return check_csv_rows(raw)


def check_csv_rows(raw: DataFrame) -> Evidence:
    integers = ("order_id", "customer_id", "event_id", "batch_no")
    stamp = F.col("updated_at")
    problems = [
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("wrong number of columns")),
        F.when(~F.coalesce(F.col("dataset").isin(*DATASETS), F.lit(False)), F.lit("unknown dataset")),
        *[F.when(~F.coalesce(F.col(c).rlike(CSV_INTEGER) & F.col(c).try_cast("bigint").isNotNull(), F.lit(False)),
                 F.lit(f"invalid integer: {c}")) for c in integers],
        F.when(~F.coalesce(F.col("amount").rlike(MONEY_PATTERN), F.lit(False)), F.lit("invalid money: amount")),
        F.when(~F.coalesce(stamp.rlike(ISO_WITH_OFFSET) & stamp.try_cast("timestamp").isNotNull(), F.lit(False)),
               F.lit("invalid timestamp: updated_at")),
        F.when(~F.coalesce(F.length("run_id").between(1, 128), F.lit(False)), F.lit("invalid text: run_id")),
    ]
    judged = raw.withColumn("reasons", F.array_compact(F.array(*problems)))
    found = judged.select(
        "bundle", F.coalesce("dataset", F.lit("row")).alias("section"), F.lit(None).cast("int").alias("pos"),
        F.explode("reasons").alias("reason"),
    )
    refused = found.select("bundle").distinct()
    good = judged.join(refused, "bundle", "left_anti").select(
        "bundle", "dataset", *[F.col(c).cast("bigint").alias(c) for c in ("order_id", "customer_id")],
        F.col("amount").cast(schemas.MONEY).alias("amount"), F.col("updated_at").cast("timestamp").alias("updated_at"),
        F.col("event_id").cast("bigint").alias("event_id"), F.col("batch_no").cast("bigint").alias("batch_no"), "run_id",
    )
    return Evidence(
        good.select("bundle").distinct(),
        {f"datasets.{d}": good.where(F.col("dataset") == d).drop("dataset") for d in DATASETS}, found,
    )


def referenced_runs(evidence: Evidence) -> DataFrame:
    """Every accepted document with the sorted run ids it mentions, in any section."""
    mentioned = F.flatten(F.array(*[
        F.coalesce(F.transform(_items(s), lambda x: _text(x, "run_id")), F.array().cast("array<string>"))
        for s in evidence.run_sections
    ]))
    return evidence.documents.withColumn("run_ids", F.array_sort(F.array_distinct(F.array_compact(mentioned))))


def provenance(evidence: Evidence, file_format: str, captured_at) -> DataFrame:
    """One row per accepted bundle: content hash, sorted run ids, capture time."""
    return referenced_runs(evidence).select(
        F.sha2(F.concat_ws("|", F.col("bundle").cast("string"), "sha256"), 256).alias("import_id"),
        F.to_json("run_ids").alias("run_ids"), F.col("bundle").alias("filename"),
        F.lit(file_format).alias("file_format"), "sha256", F.lit(captured_at).alias("captured_at"),
        F.lit(1).alias("mapping_version"), F.col("content").alias("raw_content"),
    )


def _json_value(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.simpleString()
    if kind.startswith("timestamp"):
        return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias(name)
    return (F.col(name).cast("string") if kind.startswith(("decimal", "date")) else F.col(name)).alias(name)


def _section(path: str) -> Section:
    return next(s for s in SECTIONS if s.path == path)


def export_bundles(header: DataFrame, sections: dict[str, DataFrame]) -> DataFrame:
    """JSON documents, one per bundle, that the reader above accepts again.

    ``header`` has one row per bundle: bundle, provider, resource_id, as_of and
    batch_no. Money and times travel as text. Nothing is left out; a document is one
    value, so bundles with many rows go out by ``record_lines``, which gathers nothing.
    """
    out = header.select(
        "bundle", F.lit(1).alias("version"), *[_json_value(header, c) for c in ("provider", "resource_id", "as_of", "batch_no")]
    )
    for path, rows in sections.items():
        record = F.struct(*[_json_value(rows, c) for c in _section(path).fields])
        lists = rows.groupBy("bundle").agg(F.array_sort(F.collect_list(record)).alias(f"rows:{path}"))
        out = out.join(lists, "bundle", "left")

    def listed(path: str) -> Column:
        return F.col(f"`rows:{path}`")

    data = {p.split(".")[1]: listed(p) for p in sections if p.startswith("datasets.")}
    columns = [F.col(c) for c in ("version", "provider", "resource_id", "as_of", "batch_no")]
    columns += [F.coalesce(listed(p), F.array()).alias(p) for p in sections if not p.startswith("datasets.")]
    if data:
        columns.append(F.struct(*[F.coalesce(c, F.array()).alias(n) for n, c in data.items()]).alias("datasets"))
    content = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return out.select("bundle", content.alias("content"))


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON document per line."""
    documents.select("content").write.mode("overwrite").text(path)


# Record lines: one JSON object per line with a bundle's id, a section and one record of it.

HEADER = Section("header", {"version": Field("integer", maximum=1), "provider": _TEXT, **_HEADER, "as_of": Field("timestamp", nullable=True)})


def record_lines(header: DataFrame, sections: Mapping[str, DataFrame]) -> DataFrame:
    """Every record of every bundle as a line of JSON, the header as a section of its own. No rows are brought together."""
    headed = header.withColumn("version", F.lit(1))
    lines = []
    for section, rows in [(HEADER, headed), *((_section(p), rows) for p, rows in sections.items())]:
        record = F.struct(*[_json_value(rows, c) for c in section.fields])
        line = F.struct(F.col("bundle").cast("string").alias("bundle"), F.lit(section.path).alias("section"), record.alias("record"))
        lines.append(rows.select(F.to_json(line, {"ignoreNullFields": "false"}).alias("value")))
    return reduce(DataFrame.unionByName, lines)


SPREAD = 64  # parts of a bundle


def _stored(frame: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, so that each use doesn't judge them again."""
    path = work_dir(frame.sparkSession, "records")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def parse_records(lines: DataFrame) -> Evidence:
    """Validate and type record lines (column ``value``) of bundles of any size.

    Each record is judged once, in its own row, and stored; ids that may not repeat and the one header a bundle needs
    are counted. The records of a bundle are dealt over ``SPREAD`` parts, so that none is one task's. A
    bundle with any problem is refused whole. ``documents`` has one row per accepted bundle. Lines that name no bundle
    belong to the bundle NULL, which is never accepted.
    """
    known = (HEADER, *SECTIONS)
    line, item, section = F.try_parse_json("value"), F.col("item"), F.col("section")
    records = lines.select(line.alias("line"), F.pmod(F.xxhash64("value"), F.lit(SPREAD)).alias("spread")).select(
        _text(F.col("line"), "bundle").alias("bundle"), _text(F.col("line"), "section").alias("section"),
        F.try_variant_get("line", "$.record", "variant").alias("item"), "spread")
    reasons = F.array(F.lit("unknown section"))
    for s in known:
        own = object_problems(item, s.fields)
        if s is HEADER:
            own = F.array_append(own, F.when(~F.coalesce(_text(item, "provider").isin(*PROVIDERS), F.lit(False)), F.lit("unsupported provider")))
            own = F.array_append(own, F.when(F.try_variant_get(item, "$.version", "bigint") != 1, F.lit("unsupported version")))
        reasons = F.when(section == s.path, own).otherwise(reasons)
    reasons = F.when(F.col("bundle").isNull(), F.array(F.lit("no bundle named"))).when(item.isNull(), F.array(F.lit("not an object"))).otherwise(reasons)
    stored = _stored(records.select("bundle", "section", F.to_json("item").alias("item"), "spread", F.array_compact(reasons).alias("reasons")))
    judged = stored.withColumn("item", F.parse_json("item"))
    place = F.lit(None).cast("int").alias("pos")
    found = [judged.select("bundle", "section", place, F.explode("reasons").alias("reason"))]
    for path, name in UNIQUE_FIELDS.items():
        ids = judged.where((section == path) & _text(item, name).isNotNull()).groupBy("bundle", _text(item, name).alias("id"))
        twice = ids.agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bundle").distinct()
        found.append(twice.select("bundle", F.lit(path).alias("section"), place, F.lit(f"repeated {name}").alias("reason")))
    headers = judged.groupBy("bundle").agg(F.count_if(section == "header").alias("n"))
    found.append(headers.where("n <> 1").select("bundle", F.lit("header").alias("section"), place, F.lit("not one header").alias("reason")))
    problems = reduce(DataFrame.unionByName, found)
    refused = problems.select("bundle").distinct().withColumn("spread", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))))
    good = judged.where("bundle IS NOT NULL").join(refused, ["bundle", "spread"], "left_anti").select("bundle", "section", place, "item")

    def rows(s: Section) -> DataFrame:
        return _typed_rows(s, good.where(section == s.path).drop("section"))

    return Evidence(rows(HEADER), Sections({s.path: partial(rows, s) for s in SECTIONS}), problems)
