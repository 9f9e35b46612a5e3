"""Checks of whole packages: ten producers of findings over their entries, and the status that follows.

A finding is (package, code, severity, affects_core, path, message). Producers read layers as VARIANT lines; all rules of a
layer are looked at in one pass over its records. A layer with a malformed line has that one finding and no others.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.blocks import parse_blocks
from ..sources.layers import read_documents, read_jsonl
from ..sources.package import layout

#: Structural entity types, the centres of the octave bands, and codes that are fatal.
ENTITY_TYPES = ("visual_entity", "background_region", "screen_region", "face_region", "unknown_region")
BAND_CENTERS_HZ = (31.25, 62.5, 125.0, 250.0, 500.0, 1000.0, 2000.0, 4000.0, 8000.0, 16000.0)
FATAL = ("ERR_CORE_MISSING_MANIFEST", "ERR_CORE_MISSING_SECTION", "ERR_CORE_PATH_TRAVERSAL")
OUTSIDE_CORE = ("ERR_SIGNATURE_MISMATCH", "ERR_SIGNATURE_UNREADABLE", "WARN_SIGNATURE_UNTRUSTED", "WARN_SIGNATURE_NOT_PROVIDED", "INFO_SIGNATURE_VERIFIED")


@dataclass
class Registry:
    """What records are held against: registered names, and a JSON schema for each entry (none: not checked)."""

    observation_types: tuple[str, ...] = ()
    color_buckets: tuple[str, ...] = ()
    color_spaces: tuple[str, ...] = ()
    sampling_bases: tuple[str, ...] = ()
    bucket_registry_version: str = ""
    tolerance: float = 1e-6
    schemas: dict[str, dict] = field(default_factory=dict)


# --- VARIANT values ---------------------------------------------------------------------------------------------------
def member(v: Column, name: str) -> Column:
    """A member as VARIANT; null where there is none."""
    return F.try_variant_get(v, f"$['{name}']", "variant")


def kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit(""))


def is_number(v: Column) -> Column:
    return kind(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & (F.abs(number(v)) < float("inf"))


def number(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def whole(v: Column) -> Column:
    return F.when(kind(v) == "BIGINT", F.try_variant_get(v, "$", "bigint"))


def text(v: Column) -> Column:
    return F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def items(v: Column) -> Column:
    """The elements of an array as VARIANT; null for anything else."""
    return F.when(kind(v).startswith("ARRAY<"), F.try_variant_get(v, "$", "array<variant>"))


_TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL)", "boolean": "^BOOLEAN$", "array": "^ARRAY<", "object": "^OBJECT<", "null": "^VOID$"}


def _item_rule(schema: dict, path: str, what: str):
    """Does an element break a rule of this message?"""

    def broken(x: Column) -> Column:
        out = F.lit(False)
        for bad, message in schema_rules(x, schema, path):
            out = out | F.coalesce(bad, F.lit(False)) if message == what else out
        return out

    return broken


def schema_rules(v: Column, schema: dict, path: str = "$") -> list[tuple[Column, str]]:
    """(broken, message) of each rule of a JSON schema, of its subset: type, required, additionalProperties, properties,
    items, enum, minimum, maximum, pattern, minItems, maxItems. Members that are not there break nothing but required."""
    there = v.isNotNull()
    out: list[tuple[Column, str]] = []
    types = schema.get("type", [])
    types = [types] if isinstance(types, str) else list(types)
    if types:
        out.append((there & ~kind(v).rlike("|".join(_TYPES[t] for t in types)), f"{path}: is no {' or '.join(types)}"))
    if "enum" in schema:
        names = [e for e in schema["enum"] if isinstance(e, str)]
        numbers = [float(e) for e in schema["enum"] if isinstance(e, (int, float)) and not isinstance(e, bool)]
        listed = F.coalesce(text(v).isin(*names), F.lit(False)) if names else F.lit(False)
        listed = listed | (F.coalesce(number(v).isin(*numbers), F.lit(False)) if numbers else F.lit(False)) | ((kind(v) == "VOID") if None in schema["enum"] else F.lit(False))
        out.append((there & ~listed, f"{path}: is not listed"))
    for word, bad in (("minimum", lambda x: number(v) < x), ("maximum", lambda x: number(v) > x)):
        if word in schema:
            out.append((is_number(v) & bad(float(schema[word])), f"{path}: is beyond its {word}"))
    if "pattern" in schema:
        out.append((~text(v).rlike(schema["pattern"]), f"{path}: does not match"))
    if "minItems" in schema:
        out.append((F.size(items(v)) < schema["minItems"], f"{path}: has too few items"))
    if "maxItems" in schema:
        out.append((F.size(items(v)) > schema["maxItems"], f"{path}: has too many items"))
    if isinstance(schema.get("items"), dict):
        messages = dict.fromkeys(m for _, m in schema_rules(F.lit(None).cast("variant"), schema["items"], f"{path}[]"))
        out += [(F.exists(items(v), _item_rule(schema["items"], f"{path}[]", what)), what) for what in messages]
    known = schema.get("properties", {})
    for name in schema.get("required", []):
        out.append((kind(v).startswith("OBJECT") & member(v, name).isNull(), f"{path}.{name}: is missing"))
    if schema.get("additionalProperties") is False:
        extra = F.array_except(F.json_object_keys(F.to_json(v)), F.array(*[F.lit(k) for k in known]).cast("array<string>"))
        out.append((kind(v).startswith("OBJECT<") & (F.size(extra) > 0), f"{path}: has unknown members"))
    for name, rule in known.items():
        out += schema_rules(member(v, name), rule, f"{path}.{name}")
    return out


# --- findings ---------------------------------------------------------------------------------------------------------
def found(df: DataFrame, code: Column, path: Column, message: Column) -> DataFrame:
    severity = F.when(code.isin(*FATAL), "fatal").when(code.startswith("WARN_"), "warning").when(code.startswith("INFO_"), "info").otherwise("error")
    return df.select("package", code.alias("code"), severity.alias("severity"), (~code.isin(*OUTSIDE_CORE)).alias("affects_core"), path.alias("path"), message.alias("message"))


def record_findings(lines: DataFrame, entry: str, code: str, rules: list[tuple[Column, str, str]]) -> DataFrame:
    """Findings of one layer: `code` for the first malformed line of a package, else (broken, code, message) rules."""
    rows = lines.filter(F.col("entry") == entry)
    bad = rows.filter("malformed").groupBy("package").agg(F.min("line_no").alias("line_no"))
    flags = F.array(*[F.when(F.coalesce(b, F.lit(False)), F.struct(F.lit(c).alias("code"), F.lit(m).alias("message"))) for b, c, m in rules])
    # A row a package with a malformed line; records of a package stay where they are.
    one = rows.filter(~F.col("malformed")).join(F.broadcast(bad.select("package")), "package", "left_anti").select("package", "line_no", F.explode(F.array_compact(flags)).alias("f"))
    broken = found(bad, F.lit(code), F.lit(f"/{entry}"), F.concat(F.lit("line "), F.col("line_no"), F.lit(" is not JSON")))
    return found(one, F.col("f.code"), F.concat(F.lit(f"/{entry}:"), F.col("line_no")), F.col("f.message")).unionByName(broken)


def layout_findings(entries: DataFrame) -> DataFrame:
    rows = layout(entries)
    code = F.when(F.col("code") == "ERR_CORE_UNSAFE_PATH", "ERR_CORE_PATH_TRAVERSAL").otherwise(F.col("code"))
    return found(rows, code, F.concat(F.lit("/"), "entry"), F.lit("the package's entries are not as they must be"))


def block_findings(entries: DataFrame, digest=None) -> DataFrame:
    """Broken headers and hashes of the block streams (entries that end with .bin)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for package, entry, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                bad = [b for b in parse_blocks(content.as_buffer().to_pybytes(), digest) if b["problem"]]
                rows = [{"package": package, "entry": entry, "at": b["block_offset"], "problem": b["problem"]} for b in bad]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("package", pa.string()), ("entry", pa.string()), ("at", pa.int64()), ("problem", pa.string())]))

    blocks = entries.filter(F.col("entry").endswith(".bin")).select("package", "entry", "content").mapInArrow(run, "package string, entry string, at long, problem string")
    code = F.when(F.col("problem") == "hash mismatch", "ERR_CORE_INVALID_BLOCK_HASH").otherwise("ERR_CORE_INVALID_BLOCK_HEADER")
    return found(blocks, code, F.concat(F.lit("/"), "entry", F.lit("@"), "at"), F.col("problem"))


def diarization_findings(entries: DataFrame, lines: DataFrame) -> DataFrame:
    """The transcript's diarization: not run, unavailable, or by microphones without the provenance that this needs."""
    docs = read_documents(entries.filter(F.col("entry") == "transcript/transcript.json"))
    v = F.col("v")
    status = F.coalesce(text(member(member(v, "diarization"), "status")), F.lit(""))
    speakers = F.coalesce(number(member(v, "speaker_count")), F.lit(0.0))
    by_microphone = (status == "microphone_stream_assignment") & F.col("parsed")
    processor = F.coalesce(text(member(member(v, "diarization"), "processor_id")), F.lit(""))
    sources = items(member(v, "speaker_sources"))
    group = lambda s: items(member(s, "source_audio_stream_ids"))
    primary = lambda s: text(member(s, "source_audio_stream_id"))
    owned = lambda s: F.coalesce(primary(s).isNotNull() & text(member(s, "speaker_id")).isNotNull() & F.exists(group(s), lambda g: F.coalesce(text(g) == primary(s), F.lit(False))), F.lit(False))
    ids = F.transform(sources, lambda s: text(member(s, "speaker_id")))
    fine = F.coalesce((F.size(sources) == speakers) & F.forall(sources, owned) & (F.size(F.array_distinct(ids)) == F.size(ids)), F.lit(False))
    code = (
        F.when(~F.col("parsed"), "ERR_DIARIZATION_UNAVAILABLE").when(status == "fallback_one_speaker", "WARN_DIARIZATION_FALLBACK").when(status == "unavailable", "ERR_DIARIZATION_UNAVAILABLE")
        .when((speakers == 0) & ~status.isin("ran", "microphone_stream_assignment"), "ERR_DIARIZATION_UNAVAILABLE")
    )
    state = docs.select("package", code.alias("c"), F.lit("speaker data is missing, unverified or unreadable").alias("m"), F.lit("/transcript/transcript.json").alias("p")).filter("c is not null")
    mic = docs.filter(by_microphone).select("package", processor.alias("processor"), fine.alias("fine"), F.transform(F.flatten(F.transform(sources, group)), text).alias("streams"))
    # The processor's record, the first with its id, names its inputs and streams.
    p = lines.filter((F.col("entry") == "provenance/processors.jsonl") & ~F.col("malformed")).select("package", text(member(v, "id")).alias("processor"), "line_no", "v")
    first = p.join(mic.select("package", "processor"), ["package", "processor"]).groupBy("package").agg(F.min_by("v", "line_no").alias("v"))
    rec = member(v, "reconciliation")
    whole_ = member(rec, "source_assignment_evidence").isNotNull() & member(rec, "cross_anchor_chunk_content_evidence").isNotNull() & member(rec, "maximum_duplicate_word_time_delta_us").isNotNull()
    inputs = F.filter(F.transform(items(member(v, "input_refs")), text), lambda x: x.isNotNull())
    streams = items(member(v, "input_streams"))
    maps = F.transform(streams, lambda s: F.struct(primary(s).alias("s"), text(member(s, "input_ref")).alias("i")))
    named = first.select("package", F.coalesce(whole_, F.lit(False)).alias("whole"), F.coalesce(inputs, F.array().cast("array<string>")).alias("inputs"), F.coalesce(F.filter(maps, lambda m: m["s"].isNotNull() & m["i"].isNotNull()), F.array().cast("array<struct<s:string,i:string>>")).alias("maps"))
    chunks = lines.filter((F.col("entry") == "transcript/asr_chunk_provenance.jsonl") & ~F.col("malformed")).groupBy("package").agg(F.collect_set(F.coalesce(text(member(v, "input_ref")), F.lit(""))).alias("used"))
    all_ = mic.join(named, "package", "left").join(chunks, "package", "left")
    mapped = F.transform("maps", lambda m: m["s"])
    rules = [
        (F.col("processor") == "", "no processor is named"), (~F.col("fine"), "speaker sources are not one for each speaker"), ((F.col("processor") != "") & F.col("whole").isNull(), "the processor has no record"),
        (~F.col("whole"), "the processor's record lacks its evidence"), ((F.size("inputs") == 0) | (F.size("maps") == 0), "the processor's record names no inputs"),
        (F.exists("maps", lambda m: (m["s"] == "") | ~F.array_contains("inputs", m["i"])) | (F.size(F.array_distinct(mapped)) < F.size("maps")), "streams and inputs do not match"),
        (F.exists("streams", lambda s: s.isNull() | ~F.array_contains(mapped, s)), "a speaker's source is no stream of the processor"),
        (F.col("used").isNull(), "chunks have no provenance"), (F.exists("used", lambda u: ~F.array_contains("inputs", u)), "a chunk's input is no input of the processor"),
    ]
    flags = F.array_compact(F.array(*[F.when(F.coalesce(b, F.lit(False)), F.lit(m)) for b, m in rules]))
    mic_rows = all_.select("package", F.lit("ERR_DIARIZATION_UNAVAILABLE").alias("c"), F.explode(flags).alias("m"), F.lit("/provenance/processors.jsonl").alias("p"))
    return found(state.unionByName(mic_rows), F.col("c"), F.col("p"), F.col("m"))


def entity_findings(lines: DataFrame) -> DataFrame:
    bad = ~F.coalesce(text(member(F.col("v"), "entity_type")).isin(*ENTITY_TYPES), F.lit(False))
    return record_findings(lines, "entities/entities.jsonl", "ERR_CORE_INVALID_ENTITY_RECORD", [(bad, "ERR_CORE_INVALID_ENTITY_RECORD", "entity_type is not listed")])


def _schema(registry: Registry, entry: str, code: str) -> list[tuple[Column, str, str]]:
    return [(b, code, m) for b, m in schema_rules(F.col("v"), registry.schemas[entry])] if entry in registry.schemas else []


def _confidence(v: Column) -> tuple[Column, str, str]:
    c = member(v, "confidence")
    return c.isNotNull() & ~F.coalesce(is_number(c) & number(c).between(0, 1), F.lit(False)), "ERR_TEXT_INVALID_CONFIDENCE", "confidence is not between 0 and 1"


def _observation_type(v: Column, code: str, registry: Registry) -> tuple[Column, str, str]:
    t = text(member(v, "observation_type"))
    return (~t.isin(*registry.observation_types) if registry.observation_types else t.isNotNull()), code, "observation_type is not registered"


def _normalized(v: Column, code: str) -> tuple[Column, str, str]:
    return (text(member(v, "raw_text")) != "") & (F.coalesce(text(member(v, "normalized_text")), F.lit("")) == ""), code, "normalized_text is missing"


def _unresolved(lines: DataFrame, entry: str, name: str, owners: DataFrame) -> DataFrame:
    """Records whose member `name` is a text that `owners` (package, ref) do not have; layers with a malformed line have none."""
    bad = lines.filter((F.col("entry") == entry) & F.col("malformed")).select("package").distinct()
    rows = lines.filter((F.col("entry") == entry) & ~F.col("malformed")).join(bad, "package", "left_anti").select("package", "line_no", text(member(F.col("v"), name)).alias("ref")).filter("ref is not null")
    lost = rows.join(owners.distinct(), ["package", "ref"], "left_anti")
    return found(lost, F.lit("ERR_TEXT_INVALID_REFERENCE"), F.concat(F.lit(f"/{entry}:"), F.col("line_no")), F.lit(f"{name} names no record"))


def text_findings(entries: DataFrame, lines: DataFrame, registry: Registry) -> DataFrame:
    v = F.col("v")
    raster = read_documents(entries.filter(F.col("entry") == "manifest.json")).select(
        "package", *[whole(member(member(v, "canonical_analysis_raster"), n)).alias(n) for n in ("width", "height")]
    ).filter("width > 0 and height > 0")
    box = lambda name: items(member(v, name))
    n = lambda i: number(F.get(box("bbox_norm"), F.lit(i)))
    p = lambda i: whole(F.get(box("bbox_px"), F.lit(i)))
    norm = (F.size(box("bbox_norm")) == 4) & F.forall(box("bbox_norm"), is_number) & (n(0) >= 0) & (n(1) >= 0) & (n(2) <= 1) & (n(3) <= 1) & (n(0) < n(2)) & (n(1) < n(3))
    px = (F.size(box("bbox_px")) == 4) & (p(0) >= 0) & (p(1) >= 0) & (p(0) < p(2)) & (p(1) < p(3)) & (F.col("width").isNull() | ((p(2) <= F.col("width")) & (p(3) <= F.col("height"))))
    reversed_ = lambda a, b: F.coalesce(whole(member(v, a)) > whole(member(v, b)), F.lit(False))
    regions, observations, values = "text/text_regions.jsonl", "text/text_observations.jsonl", "text/numeric_values.jsonl"
    bad_region, bad_observation, bad_value = "ERR_TEXT_INVALID_REGION_RECORD", "ERR_TEXT_INVALID_OBSERVATION_RECORD", "ERR_TEXT_INVALID_NUMERIC_EXTRACTION"
    out = record_findings(lines.filter(F.col("entry") == regions).join(raster, "package", "left"), regions, bad_region, [
        *_schema(registry, regions, bad_region), (~F.coalesce(norm & px, F.lit(False)), "ERR_TEXT_INVALID_BOUNDING_BOX", "boxes are outside their bounds"),
        (reversed_("start_us", "end_us") | reversed_("frame_start", "frame_end"), "ERR_TEXT_INVALID_TIMING", "times or frames are reversed"), _confidence(v), _observation_type(v, bad_region, registry),
    ])
    out = out.unionByName(record_findings(lines, observations, bad_observation, [
        *_schema(registry, observations, bad_observation), _confidence(v), _observation_type(v, bad_observation, registry), _normalized(v, "ERR_TEXT_INVALID_NORMALIZED_TEXT"),
    ]))
    out = out.unionByName(record_findings(lines, values, bad_value, [*_schema(registry, values, bad_value), _confidence(v), _normalized(v, bad_value)]))
    owners = lambda entry, name: lines.filter((F.col("entry") == entry) & ~F.col("malformed")).select("package", text(member(v, name)).alias("ref")).filter("ref is not null")
    for entry, name, owner in ((observations, "text_region_id", regions), (values, "text_region_id", regions), (values, "text_observation_id", observations)):
        out = out.unionByName(_unresolved(lines, entry, name, owners(owner, name)))
    return out


def color_findings(lines: DataFrame, registry: Registry) -> DataFrame:
    entry, v = "colors/color_observations.jsonl", F.col("v")
    cover = F.when(kind(member(v, "bucket_coverage")).startswith("OBJECT"), F.try_variant_get(member(v, "bucket_coverage"), "$", "map<string,variant>"))
    good = lambda x: F.coalesce(is_number(x) & number(x).between(0, 1), F.lit(False))
    # What several rules look at is made once.
    lines = lines.filter(F.col("entry") == entry).withColumn("_cover", cover).withColumn("_said", member(v, "coverage_total")).withColumn("_top", text(member(v, "dominant_bucket")))
    cover, said, top = F.col("_cover"), F.col("_said"), F.col("_top")
    lines = lines.withColumn("_shares", F.map_values(cover)).withColumn("_of", F.try_element_at(cover, top))
    shares, of = F.col("_shares"), F.col("_of")
    lines = lines.withColumn("_total", F.aggregate(F.filter(shares, good), F.lit(0.0), lambda s, x: s + number(x))).withColumn("_most", F.array_max(F.transform(F.filter(shares, is_number), number)))
    total, most = F.col("_total"), F.col("_most")
    listed = lambda name, names: ~text(member(v, name)).isin(*names) if names else text(member(v, name)).isNotNull()
    code = "ERR_COLOR_INVALID_OBSERVATION_RECORD"
    return record_findings(lines, entry, code, [
        *_schema(registry, entry, code), (listed("color_space", registry.color_spaces), "ERR_COLOR_INVALID_COLOR_SPACE", "color_space is not registered"),
        (text(member(v, "color_bucket_registry_version")) != registry.bucket_registry_version, code, "color_bucket_registry_version is not registered"),
        (listed("sampling_basis", registry.sampling_bases), "ERR_COLOR_INVALID_SAMPLING_BASIS", "sampling_basis is not registered"),
        (F.exists(F.map_keys(cover), lambda k: ~k.isin(*registry.color_buckets)) if registry.color_buckets else F.size(cover) > 0, "ERR_COLOR_INVALID_BUCKET_ID", "a bucket is not registered"),
        (F.exists(shares, lambda x: ~good(x)), "ERR_COLOR_INVALID_PERCENTAGE_BOUNDS", "a share is not between 0 and 1"),
        (F.abs(total - 1.0) > registry.tolerance, "ERR_COLOR_INVALID_PERCENTAGE_TOTAL", "shares do not sum to 1"),
        (cover.isNotNull() & is_number(said) & (F.abs(number(said) - total) > registry.tolerance), "ERR_COLOR_INVALID_PERCENTAGE_TOTAL", "coverage_total is not the sum of the shares"),
        (top.isNotNull() & cover.isNotNull() & ~F.coalesce(is_number(of), F.lit(False)), "ERR_COLOR_INVALID_DOMINANT_BUCKET", "dominant_bucket has no share"),
        (is_number(of) & (most - number(of) > registry.tolerance), "ERR_COLOR_INVALID_DOMINANT_BUCKET", "dominant_bucket has not the largest share"),
    ])


def _streams(entries: DataFrame) -> DataFrame:
    """(package, ids) of the recorded audio streams; packages that do not say, or not in proper form, are left out."""
    ids = items(member(F.col("v"), "original_audio_stream_ids"))
    docs = read_documents(entries.filter(F.col("entry") == "media/audio/audio_absence.json")).filter("parsed")
    return docs.select("package", ids.alias("ids")).filter(F.forall("ids", lambda x: kind(x) == "STRING")).select("package", F.transform("ids", text).alias("ids"))


def _series_findings(entries: DataFrame, lines: DataFrame, registry: Registry, name: str, values: list[tuple[Column, str, str]], summary: list[tuple[Column, str]]) -> DataFrame:
    """Windows and summary of an audio series: values, times, order within each target, and targets that are recorded."""
    entry, whole_entry, v = f"media/audio/{name}.jsonl", f"media/audio/{name}_summary.json", F.col("v")
    code = lambda what: f"ERR_MEDIA_INVALID_{name.upper()}_{what}"
    streams = _streams(entries)
    rows = lines.filter(F.col("entry") == entry).join(streams, "package", "left")
    start, end, target = whole(member(v, "start_us")), whole(member(v, "end_us")), text(member(v, "target_id"))
    timed = start.isNotNull() & end.isNotNull()
    # The furthest end so far of the target's windows that have both times, no less than 0 after the first.
    before = Window.partitionBy("package", F.coalesce(target, F.lit(""))).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("reach", F.max(F.when(timed, F.greatest(end, F.lit(0)))).over(before))
    out = record_findings(rows, entry, code("RECORD"), [
        *_schema(registry, entry, code("RECORD")), *values, (timed & ((start < 0) | (end <= start)), code("TIMING"), "times are negative or reversed"),
        (timed & (start < F.col("reach")), code("TIMING"), "windows of one target overlap or are out of order"), (~F.array_contains("ids", target), code("TARGET"), "target_id is no recorded stream"),
    ])
    docs = read_documents(entries.filter(F.col("entry") == whole_entry)).join(streams, "package", "left")
    targets = F.transform(items(member(v, "streams")), lambda s: text(member(s, "target_id")))
    rules = [(~F.col("parsed"), code("SUMMARY"), "is not JSON"), *[(b, code("SUMMARY"), m) for b, m in summary], *_schema(registry, whole_entry, code("SUMMARY")),
             (F.exists(targets, lambda t: t.isNotNull() & ~F.array_contains("ids", t)), code("TARGET"), "a stream's target_id is no recorded stream")]
    flags = F.array_compact(F.array(*[F.when(F.coalesce(b, F.lit(False)), F.struct(F.lit(c).alias("code"), F.lit(m).alias("message"))) for b, c, m in rules]))
    return out.unionByName(found(docs.select("package", F.explode(flags).alias("f")), F.col("f.code"), F.lit(f"/{whole_entry}"), F.col("f.message")))


def loudness_findings(entries: DataFrame, lines: DataFrame, registry: Registry) -> DataFrame:
    values = []
    for name in ("momentary_lufs", "shortterm_lufs", "true_peak_dbtp"):
        x = member(F.col("v"), name)
        values.append((~F.coalesce(is_number(x) | (kind(x) == "VOID"), F.lit(False)), "ERR_MEDIA_INVALID_LOUDNESS_VALUE", f"{name} is neither a number nor null"))
    return _series_findings(entries, lines, registry, "loudness", values, [])


def spectrum_findings(entries: DataFrame, lines: DataFrame, registry: Registry) -> DataFrame:
    bands, centers = items(member(F.col("v"), "bands")), items(member(F.col("v"), "band_centers_hz"))
    size = F.lit(len(BAND_CENTERS_HZ))
    odd = F.exists(bands, lambda x: ~F.coalesce(is_number(x) | (kind(x) == "VOID"), F.lit(False)))
    values = [(F.size(bands) != size, "ERR_MEDIA_INVALID_SPECTRUM_VALUE", "there are not ten bands"), ((F.size(bands) == size) & odd, "ERR_MEDIA_INVALID_SPECTRUM_VALUE", "a band is neither a number nor null")]
    table = F.array(*[F.lit(c) for c in BAND_CENTERS_HZ])
    same = F.coalesce(F.transform(centers, number) == table, F.lit(False))
    return _series_findings(entries, lines, registry, "spectrum", values, [((F.size(centers) == size) & ~same, "band_centers_hz are not the octave bands")])


def capture_findings(entries: DataFrame, registry: Registry) -> DataFrame:
    entry, code = "provenance/capture.json", "ERR_PROVENANCE_INVALID_CAPTURE"
    docs = read_documents(entries.filter(F.col("entry") == entry))
    rules = [(~F.col("parsed"), "is not JSON"), *(schema_rules(F.col("v"), registry.schemas[entry]) if entry in registry.schemas else [])]
    flags = F.array_compact(F.array(*[F.when(F.coalesce(b, F.lit(False)), F.lit(m)) for b, m in rules]))
    return found(docs.select("package", F.explode(flags).alias("m")), F.lit(code), F.lit(f"/{entry}"), F.col("m"))


def index_findings(manifest: DataFrame, tables: DataFrame) -> DataFrame:
    """Tables (package, table, rows, digest) of an index against those that its manifest lists."""
    said = manifest.select("package", "table", F.col("rows").alias("said_rows"), F.col("digest").alias("said_digest"))
    both = said.join(tables, ["package", "table"], "full_outer")
    code = F.when(F.col("rows").isNull(), "ERR_CORE_INDEX_SCHEMA_INVALID").when(F.col("said_rows").isNull(), "ERR_CORE_INDEX_MANIFEST_INVALID").when(
        (F.col("rows") != F.col("said_rows")) | ~F.col("digest").eqNullSafe(F.col("said_digest")), "ERR_CORE_INDEX_LOGICAL_MISMATCH"
    )
    return found(both.withColumn("c", code).filter("c is not null"), F.col("c"), F.concat(F.lit("/index/"), "table"), F.lit("the index and its manifest differ"))


def validate_package(entries: DataFrame, registry: Registry, manifest: DataFrame | None = None, tables: DataFrame | None = None, digest=None) -> DataFrame:
    """All findings of the packages in entries (package, entry, content)."""
    lines = read_jsonl(entries)
    parts = [
        layout_findings(entries), block_findings(entries, digest), diarization_findings(entries, lines), entity_findings(lines), text_findings(entries, lines, registry),
        color_findings(lines, registry), loudness_findings(entries, lines, registry), spectrum_findings(entries, lines, registry), capture_findings(entries, registry),
    ]
    if manifest is not None and tables is not None:
        parts.append(index_findings(manifest, tables))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def package_status(entries: DataFrame, findings: DataFrame) -> DataFrame:
    """(package, infos, warnings, errors, status): invalid with an error that affects the core, else valid_with_warnings
    with such a warning, else valid."""
    core = F.col("affects_core")
    error = F.col("severity").isin("error", "fatal")
    n = findings.groupBy("package").agg(
        F.count_if(F.col("severity") == "info").alias("infos"), F.count_if(F.col("severity") == "warning").alias("warnings"), F.count_if(error).alias("errors"),
        F.count_if(core & error).alias("_e"), F.count_if(core & (F.col("severity") == "warning")).alias("_w"),
    )
    all_ = entries.select("package").distinct().join(n, "package", "left").fillna(0)
    return all_.withColumn("status", F.when(F.col("_e") > 0, "invalid").when(F.col("_w") > 0, "valid_with_warnings").otherwise("valid")).drop("_e", "_w")
