"""Scans for secrets with an incremental ledger of blobs, in DataFrame functions only.

Every version of a text is addressed by the digest of its content; a blob is one distinct
text.  The ledger says which rules, in which version, a blob has been scanned with and what
they found.  A scan touches only the pairs of blob and rule version that the ledger does
not hold, adds them, and findings are joined back to every path whose version is that blob.

Defined results
    NULL texts are empty ones, without findings.  Rows may repeat and keys may be NULL: every
    row gets the findings of its text.  Matches are leftmost and do not overlap within a
    rule; places are code points, the end not included.  A text's places are summed row by row, so any number
    of matches is fine, but the findings of one text are one list.  An empty table gives no rows.
    The result holds the asked key columns only, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from statloom.llm.text import filled
from statloom.operators.ordered import join_small
from statloom.session import materialise


@dataclass(frozen=True)
class Rule:
    """A pattern; ``group`` names the part that needs ``least`` characters.

    A changed pattern needs a new version, else blobs already scanned keep the old findings.
    """

    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1


#: The rules every scan states, in the order in which findings at one place are listed.
BASE: dict[str, Rule] = {
    "assign": Rule(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=12),
    "access": Rule(r"AKIA[A-Z0-9]+", least=18),
    "hex": Rule(r"[0-9a-f]{16,}"),
}
#: Published forms of keys of common services; fixed values.
ADDED: dict[str, Rule] = {
    "pem": Rule(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    "jwt": Rule(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "github": Rule(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "slack": Rule(r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    "google": Rule(r"AIza[A-Za-z0-9_-]{35}"),
}
RULES: dict[str, Rule] = BASE | ADDED

#: Rows of one blob that one task may join.
MOST_COPIES = 100_000


def _names(rules: Mapping[str, Rule]) -> dict[str, str]:
    return {kind: f"{kind}@{rule.version}" for kind, rule in rules.items()}


def addressed(versions: DataFrame, paths: Sequence[str], text: str = "text") -> DataFrame:
    """``paths`` of every version, with ``blob_id`` (digest of the text) and ``blob`` (the text)."""
    return versions.select(*paths, F.sha2(F.encode(filled(text), "UTF-8"), 256).alias("blob_id"), filled(text).alias("blob"))


def _scanned_with(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("blob_id").agg(F.flatten(F.collect_list("rules")).alias("seen"))


def unseen(blobs: DataFrame, ledger: DataFrame | None, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """``blob_id``, ``blob`` and ``todo`` (rule versions not in the ledger), one row per blob with any left.

    Copies collapse before texts are shuffled.  With a ledger the digests are compared
    first, so the texts of blobs that are seen already do not move.
    """
    wanted = F.array(*[F.lit(n) for n in _names(rules).values()])
    blobs = blobs.select("blob_id", "blob")
    if ledger is None:
        return blobs.groupBy("blob_id").agg(F.first("blob").alias("blob")).withColumn("todo", wanted)
    left = blobs.select("blob_id").distinct().join(_scanned_with(ledger), "blob_id", "left")
    left = left.select("blob_id", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
    texts = join_small(blobs, left.where(F.size("todo") > 0), ["blob_id"])
    return texts.groupBy("blob_id").agg(F.first("blob").alias("blob"), F.first("todo").alias("todo"))


def _hits(blob: Column, kind: str, rule: Rule) -> Column:
    """Matches in order: characters before each since the last one, its length, whether it counts."""
    pattern = F.lit(rule.pattern)
    gaps = F.split(blob, rule.pattern, -1)
    whole = F.regexp_extract_all(blob, pattern, F.lit(0))
    part = F.regexp_extract_all(blob, pattern, F.lit(rule.group)) if rule.group else whole
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("hit"), part.alias("part"))
    hits = F.transform(
        F.filter(zipped, lambda z: z["hit"].isNotNull()),
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"),
            i.cast("long").alias("i"),
            F.char_length(z["gap"]).cast("long").alias("gap"),
            F.char_length(z["hit"]).cast("long").alias("length"),
            (F.char_length(z["part"]) >= rule.least).alias("counts"),
        ),
    )
    nothing = F.array().cast("array<struct<kind:string,i:bigint,gap:bigint,length:bigint,counts:boolean>>")
    return F.when(blob.rlike(rule.pattern), hits).otherwise(nothing)


def scan(blobs: DataFrame, ledger: DataFrame | None = None, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """New ledger rows: ``blob_id``, ``rules`` scanned now, ``findings`` (kind, start, end), ordered by start."""
    names = _names(rules)
    todo = materialise(unseen(blobs, ledger, rules))
    found = [F.when(F.array_contains("todo", name), _hits(F.col("blob"), kind, rules[kind])) for kind, name in names.items()]
    listed = F.flatten(F.filter(F.array(*found), lambda x: x.isNotNull()))
    rows = todo.select("blob_id", F.explode(listed).alias("hit")).select("blob_id", "hit.*")
    before = Window.partitionBy("blob_id", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(before)
    order = F.array_position(F.array(*[F.lit(k) for k in rules]), F.col("kind"))
    spans = rows.withColumn("end", end).where("counts").groupBy("blob_id")
    spans = spans.agg(
        F.sort_array(
            F.collect_list(F.struct((F.col("end") - F.col("length")).alias("start"), order.alias("order"), F.col("kind"), F.col("end")))
        ).alias("spans")
    )
    findings = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    nothing = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return todo.join(spans, "blob_id", "left").select("blob_id", F.col("todo").alias("rules"), F.coalesce(findings, nothing).alias("findings"))


def findings_by_blob(ledger: DataFrame, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """``blob_id`` and ``findings`` of these rule versions, from all scans, ordered by start, then as the rules are listed.

    Findings of a rule version that has been replaced stay in the ledger and are left out here.
    """
    names = _names(rules)
    kinds = F.array(*[F.lit(k) for k in names])
    valid = F.filter(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("name")) for k, n in names.items()]), lambda r: F.array_contains("rules", r["name"]))
    current = F.transform(valid, lambda r: r["kind"])
    kept = F.filter("findings", lambda f: F.array_contains(current, f["kind"]))
    keyed = F.transform(kept, lambda f: F.struct(f["start"].alias("start"), F.array_position(kinds, f["kind"]).alias("order"), f["kind"].alias("kind"), f["end"].alias("end")))
    # a scan that ran twice after a lost job states the same findings twice
    merged = ledger.select("blob_id", keyed.alias("keyed")).groupBy("blob_id").agg(F.flatten(F.collect_list("keyed")).alias("keyed"))
    back = F.transform(F.array_sort(F.array_distinct("keyed")), lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")))
    return merged.select("blob_id", back.alias("findings"))


def to_paths(addresses: DataFrame, results: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """Rows of ``addresses`` with the one row of ``results`` for their ``blob_id``.

    A blob with many copies is split: its result is repeated for every ``most_copies`` of them.  Only
    the identifiers of such blobs are sent to all tasks; there is at most one for every
    ``most_copies`` rows, and where these are many the join is a shuffle.
    """
    sizes = addresses.groupBy("blob_id").agg(F.count(F.lit(1)).alias("copies"))
    parts = F.ceil(F.col("copies") / most_copies).cast("int")
    results = results.join(sizes.select("blob_id", parts.alias("parts")), "blob_id")
    spread = results.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    hot = sizes.where(F.col("copies") > most_copies).select("blob_id", parts.alias("parts"))
    others = [c for c in addresses.columns if c != "blob_id"]
    rows = join_small(addresses, hot, ["blob_id"], "left")
    salt = F.pmod(F.xxhash64(*others) if others else F.xxhash64("blob_id"), F.coalesce("parts", F.lit(1))).cast("int")
    return rows.withColumn("part", salt).drop("parts").join(spread, ["blob_id", "part"]).drop("part")


def find(
    versions: DataFrame, paths: Sequence[str] = ("doc_id",), text: str = "text", rules: Mapping[str, Rule] = RULES, ledger_path: str | None = None
) -> DataFrame:
    """``paths``, ``blob_id`` and ``findings`` of every row of ``versions``.

    ``ledger_path`` names the folder where the ledger is kept; a second call scans only
    what is new.  One write adds a scan as a whole, so a lost job leaves the ledger as it
    was.  Without it every distinct text is scanned once.
    """
    paths = list(paths)
    path_names = {p: f"path_{i}" for i, p in enumerate(paths)}
    spark = versions.sparkSession
    blobs = addressed(versions.select(*[F.col(p).alias(n) for p, n in path_names.items()], F.col(text).alias("content")), list(path_names.values()), "content")
    ledger = _opened(spark, ledger_path)
    new = scan(blobs, ledger, rules)
    if ledger_path:
        new.write.mode("append").parquet(ledger_path)
        ledger = _opened(spark, ledger_path)
    else:
        ledger = materialise(new)
    addresses = materialise(blobs.drop("blob"))
    found = to_paths(addresses, findings_by_blob(ledger, rules))
    return found.select(*[F.col(n).alias(p) for p, n in path_names.items()], "blob_id", "findings")


_LEDGER = "blob_id string, rules array<string>, findings array<struct<kind:string,start:bigint,end:bigint>>"


def _opened(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The ledger kept at ``path``; None where there is none yet."""
    if path is None:
        return None
    try:
        return spark.read.schema(_LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def listed(findings: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
