"""Files and generations against their locks and contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import json_text
from tidemark.functions.cells import FLOAT_LIMITS, cell_violation, is_legal
from tidemark.functions.predicates import is_canonical_event_time, is_true
from tidemark.functions.values import plain_decimal_text
from tidemark.operators.checks import ContractError, count_violations
from tidemark.operators.digests import keyed_digest

# Text forms of generation identities.
SHA256_REGEX = "[0-9a-f]{64}"
PUBLICATION_REGEX = "[0-9a-f]{12}4[0-9a-f]{3}[89ab][0-9a-f]{15}"
SCALES = ["tiny", "small", "medium"]


def file_digests(files: DataFrame) -> DataFrame:
    """(path, bytes, sha256) of whole files read as bytes, one file per row."""
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def utf8_violations(files: DataFrame) -> DataFrame:
    """Files whose bytes are not valid UTF-8."""
    return files.where(~F.is_valid_utf8("content")).select("path")


def bom_violations(files: DataFrame) -> DataFrame:
    """Files that begin with a UTF-8 byte order mark; line readers skip it silently."""
    return files.where(F.hex(F.substring("content", 1, 3)) == "EFBBBF").select("path")


def verify_lock(observed: DataFrame, lock: DataFrame) -> DataFrame:
    """(name, status) per file: ok, missing, unexpected, size_mismatch or digest_mismatch."""
    joined = observed.alias("o").join(lock.alias("l"), "name", "full")
    status = (
        F.when(F.col("o.sha256").isNull(), "missing")
        .when(F.col("l.sha256").isNull(), "unexpected")
        .when(F.col("o.bytes") != F.col("l.bytes"), "size_mismatch")
        .when(F.col("o.sha256") != F.col("l.sha256"), "digest_mismatch")
        .otherwise("ok")
    )
    return joined.select("name", status.alias("status"))


def manifest_digest(manifest: DataFrame, name: str = "manifest_sha256") -> DataFrame:
    """One row: digest over the canonical JSON of every manifest row, in any row order."""
    canonical = F.to_json(F.struct(*sorted(manifest.columns)), {"ignoreNullFields": "false"})
    return keyed_digest(manifest.withColumn("_all", F.lit(0)), ["_all"], canonical, name).drop("_all")


def canonical_manifest_digest(members: DataFrame, max_members: int = 10_000) -> DataFrame:
    """One row: sha256 of the compact JSON object of (name, value) rows, its members in name order.

    A manifest is a bounded list; more than ``max_members`` rows fail the job. ``value`` is JSON text.
    For sets without a bound there is ``manifest_digest``.
    """
    count = members.agg(F.count(F.lit(1))).scalar()
    fits = count <= max_members
    quoted = F.to_json(F.array(F.col("name")))
    member = F.concat(F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit(":"), F.col("value"))
    packed = members.where(fits).agg(F.sort_array(F.collect_list(F.struct("name", member.alias("member")))).alias("all"))
    text = F.concat(F.lit("{"), F.concat_ws(",", F.col("all.member")), F.lit("}"))
    too_many = F.raise_error(F.lit("manifest exceeds its bound"))
    return packed.select(F.when(fits, F.sha2(text, 256)).otherwise(too_many).alias("manifest_sha256"))


def inventory_positions(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Compare two (position, name) lists: rows whose names differ or that exist on one side only."""
    joined = expected.alias("e").join(observed.alias("o"), "position", "full")
    return joined.where(~F.col("e.name").eqNullSafe(F.col("o.name"))).select(
        "position", F.col("e.name").alias("expected_name"), F.col("o.name").alias("observed_name")
    )


def parse_generation(uris: DataFrame, uri: str, dataset: str, bucket: str = "landing") -> DataFrame:
    """Add plan_id, publication_id and object_name parsed from immutable object URIs; null when malformed."""
    pattern = f"^s3://{bucket}/{dataset}/_generations/({SHA256_REGEX})/({PUBLICATION_REGEX})/([A-Za-z0-9._-]+)$"
    legal = F.col(uri).rlike(pattern)
    parts = {
        name: F.when(legal, F.regexp_extract(uri, pattern, position))
        for position, name in enumerate(["plan_id", "publication_id", "object_name"], start=1)
    }
    return uris.withColumns(parts)


def generation_checks(parsed: DataFrame, uri: str, plan_id: str, publication_id: str) -> DataFrame:
    """Well-formed, unique URIs of exactly the declared generation."""
    per_uri = parsed.groupBy(uri, "plan_id", "publication_id", "object_name").agg(F.count(F.lit(1)).alias("_rows"))
    return count_violations(
        per_uri,
        {
            "uri_malformed": F.col("object_name").isNull(),
            "uri_repeated": F.col("_rows") > 1,
            "generation_differs": (F.col("plan_id") != plan_id) | (F.col("publication_id") != publication_id),
        },
    )


def provenance_checks(properties: DataFrame) -> DataFrame:
    """Identity rules of one provenance property set: (scale, plan_id, publication_id, manifest_sha256)."""
    return count_violations(
        properties,
        {
            "scale_unknown": ~is_true(F.col("scale").isin(SCALES)),
            "plan_malformed": ~is_true(F.col("plan_id").rlike(f"^{SHA256_REGEX}$")),
            "publication_malformed": ~is_true(F.col("publication_id").rlike(f"^{PUBLICATION_REGEX}$")),
            "manifest_malformed": ~is_true(F.col("manifest_sha256").rlike(f"^{SHA256_REGEX}$")),
        },
    )


def compare_columns(observed: DataFrame, contract: DataFrame) -> DataFrame:
    """Differences between observed and contracted (position, column_name, logical_type)."""
    joined = contract.alias("c").join(observed.alias("o"), "position", "full")
    same = F.col("c.column_name").eqNullSafe(F.col("o.column_name")) & F.col("c.logical_type").eqNullSafe(
        F.col("o.logical_type")
    )
    return joined.where(~same).select(
        "position",
        F.col("c.column_name").alias("contract_column"),
        F.col("c.logical_type").alias("contract_type"),
        F.col("o.column_name").alias("observed_column"),
        F.col("o.logical_type").alias("observed_type"),
    )


def cell_checks(
    rows: DataFrame, contract: Sequence[tuple[str, str, bool]], corrupt: str | None = None
) -> DataFrame:
    """Violations per column of all-text rows, and rows of the wrong width, in one pass."""
    violations = {
        f"{name}:{kind}": cell_violation(F.col(name), kind, nullable) for name, kind, nullable in contract
    }
    if corrupt is not None:
        violations["row_width"] = F.col(corrupt).isNotNull()
    return count_violations(rows, violations)


VARIANT, TEXTS = "_variant", "_texts"


def _shape(path: str) -> str:
    return f"_shape_{path.replace('.', '_')}"


def _plain(path: str) -> str:
    return f"_plain_{path.replace('.', '_')}"


def _json_member_violation(path: str, kind: str, nullable: bool) -> Column:
    """A declared member: absent or JSON null only when nullable, otherwise of the declared type."""
    shape = F.col(_shape(path))
    missing = shape.isNull() | (shape == "VOID")
    text = F.col(f"{TEXTS}.{path}")
    if kind == "string":
        legal = shape == "STRING"
    elif kind == "boolean":
        legal = shape == "BOOLEAN"
    elif kind in ("date", "timestamp", "timestamp-tz"):
        legal = (shape == "STRING") & is_legal(text, kind)
    elif kind in FLOAT_LIMITS:
        number = F.abs(text.try_cast("double"))
        legal = (shape != "STRING") & text.rlike(json_text.NUMBER_TEXT) & (number <= F.lit(FLOAT_LIMITS[kind]))
    elif kind.startswith(("int", "uint")):
        legal = (shape != "STRING") & is_legal(text, kind)
    elif kind.startswith("decimal("):
        legal = (shape != "STRING") & is_legal(F.col(_plain(path)), kind)
    elif kind == "json":
        legal = shape.isNotNull()
    else:
        raise ValueError(f"unsupported JSON member type: {kind}")
    return F.when(missing, F.lit(not nullable)).otherwise(~is_true(legal))


def _members_by_parent(paths: Sequence[str]) -> dict[str, set[str]]:
    members: dict[str, set[str]] = {}
    for path in paths:
        parts = path.split(".")
        for depth, part in enumerate(parts):
            members.setdefault(".".join(parts[:depth]), set()).add(part)
    return members


def json_line_checks(
    lines: DataFrame,
    line: str,
    contract: Sequence[tuple[str, str, bool]],
    exact: bool = False,
    max_depth: int = json_text.CONTRACT_MAX_DEPTH,
    max_bytes: int = json_text.CONTRACT_MAX_LINE_BYTES,
    blank_allowed: bool = True,
) -> DataFrame:
    """Check rows for JSON lines: bounds, one object per line, no duplicate members, typed paths.

    With ``exact`` the contract's paths are the only members allowed; otherwise they are a minimum.
    """
    text = F.col(line)
    blank = F.length(F.trim(text)) == 0
    records = (lines.where(~blank) if blank_allowed else lines).select(line)
    parsed = records.withColumns(
        {
            VARIANT: json_text.parsed(text),
            TEXTS: json_text.member_texts(text, [path for path, _, _ in contract]),
        }
    )
    parsed = parsed.withColumns(
        {
            "_object": json_text.is_object(text, F.col(VARIANT)),
            **{_shape(path): json_text.member_shape(F.col(VARIANT), path) for path, _, _ in contract},
            # The parsed value: zeros written at the end of a JSON number do not count as digits.
            **{
                _plain(path): json_text.member(F.col(VARIANT), path, "decimal(38,18)").cast("string")
                for path, kind, _ in contract
                if kind.startswith("decimal(")
            },
        }
    )
    decimals = [path for path, kind, _ in contract if kind.startswith("decimal(")]
    if decimals:
        parsed = parsed.withColumns({_plain(path): plain_decimal_text(F.col(_plain(path))) for path in decimals})
    is_object = F.col("_object")
    rules: dict[str, Column] = {
        "line_too_long": F.octet_length(text) > max_bytes,
        "depth_exceeded": json_text.deeper_than(text, max_depth),
        "not_one_object": ~is_object,
    }
    if not blank_allowed:
        rules["blank_line"] = blank
    for path, kind, nullable in contract:
        rules[f"{path}:{kind}"] = is_object & _json_member_violation(path, kind, nullable)
    if exact:
        for parent, members in _members_by_parent([path for path, _, _ in contract]).items():
            wanted = F.array(*[F.lit(name) for name in sorted(members)])
            found = text if parent == "" else F.get_json_object(text, f"$.{parent}")
            rules[f"members_differ:{parent or 'record'}"] = ~F.array_sort(F.json_object_keys(found)).eqNullSafe(wanted)
    return count_violations(parsed, rules, empty="no_records")


def landing_event_checks(lines: DataFrame, line: str = "value") -> DataFrame:
    """Strict landing form of event lines: bounds, required non-blank text, canonical time."""
    text, variant = F.col(line), F.col(VARIANT)
    paths = ["id", "type", "actor.login", "repo.name", "created_at"]

    def blank_member(path: str) -> Column:
        return ~is_true(F.length(F.trim(F.when(json_text.member_shape(variant, path) == "STRING", member(path)))) > 0)

    def member(path: str) -> Column:
        return json_text.member(variant, path, "string")

    rules = {
        "line_too_long": F.octet_length(text) > json_text.LANDING_MAX_LINE_BYTES,
        "blank_line": F.length(F.trim(text)) == 0,
        "depth_exceeded": json_text.deeper_than(text, json_text.LANDING_MAX_DEPTH),
        "not_one_object": ~json_text.is_object(text, variant),
        **{f"{path}:text": blank_member(path) for path in paths},
        "created_at:canonical": ~is_canonical_event_time(member("created_at")),
    }
    parsed = lines.select(line).withColumn(VARIANT, json_text.parsed(text))
    return count_violations(parsed, rules, empty="no_records")


def require_single_generation(parsed: DataFrame) -> tuple[str, str]:
    """The one (plan_id, publication_id) all URIs share; anything else is an error."""
    pairs = parsed.select("plan_id", "publication_id").distinct().limit(2).collect()
    if len(pairs) != 1 or pairs[0]["plan_id"] is None:
        raise ContractError("object URIs do not share one well-formed generation")
    return pairs[0]["plan_id"], pairs[0]["publication_id"]
