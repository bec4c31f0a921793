"""Secrets in versioned texts: each distinct text is scanned once for each rule version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import batch_name, lower_ascii, settled
from murmur.session import scratch_folder


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of `pattern`, from the left, without overlap, whose `group` has `least` characters.

    A text without any of `hints` (looked for in the lower-cased text if `folded`) has no match.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    hints: tuple[str, ...] = ()
    folded: bool = False
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules, in the order in which equal starts are listed.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2,
         ("password", "passwd", "secret", "token", "apikey", "api_key"), True),
    Rule("access", r"AKIA[A-Z0-9]+", 18, 0, ("AKIA",)),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Published prefixes and forms of credentials.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0, ("PRIVATE KEY-----",)),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 0, ("gho_", "ghp_", "ghs_", "ghu_", "ghr_")),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0, ("xox",)),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0, ("AIza",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0, ("eyJ",)),
)
RULES = BASE_RULES + MORE_RULES
#: Put around matches. Characters of this kind in a text are first swapped for SWAPPED: no rule matches either.
MARK, SWAPPED = "\x01", "\x02"

LEDGER = "blob binary, scanned array<string>, spans array<struct<rule:string,start:int,end:int>>"


def blob_id(text: Column) -> Column:
    """The content address of a text; null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _parts(text: Column, rule: Rule) -> Column:
    """The text cut at the rule's matches: gap, match, gap, ..., gap; null if there is no match."""
    marked = F.regexp_replace(F.translate(text, MARK, SWAPPED), rule.pattern, f"{MARK}$0{MARK}")
    parts = F.split(marked, MARK)
    if not rule.hints:
        return parts
    where = lower_ascii(text) if rule.folded else text
    test = F.contains(where, F.lit(rule.hints[0]))
    for hint in rule.hints[1:]:
        test = test | F.contains(where, F.lit(hint))
    return F.when(test, parts)


def _spans(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans) of blobs with matches; blobs: blob, text, done (names of the rules already applied)."""
    order = F.create_map(*[x for n, r in enumerate(rules) for x in (F.lit(r.name), F.lit(n))])
    long_enough = F.coalesce(*[F.when(F.col("rule") == r.name, F.length(
        F.regexp_extract("part", r.pattern, r.group) if r.group else F.col("part")) >= r.least) for r in rules])
    scanned = blobs.select("blob", F.explode(F.array(*[F.struct(
        F.lit(r.name).alias("rule"), F.when(~F.array_contains("done", r.name), _parts(F.col("text"), r)).alias("parts"))
        for r in rules])).alias("s")).where(F.size("s.parts") > 1)
    places = scanned.select("blob", "s.rule", F.posexplode("s.parts").alias("n", "part"))
    # Only lengths and matches go on, so the shuffle below carries no gaps.
    kept = places.select("blob", "rule", "n", F.length("part").alias("size"), F.when(F.col("n") % 2 == 1, F.col("part")).alias("part"))
    before = Window.partitionBy("blob", "rule").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    found = (kept.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("int"))
             .where((F.col("n") % 2 == 1) & long_enough)
             .select("blob", "start", order[F.col("rule")].alias("order"), "rule", (F.col("start") + F.col("size")).alias("end")))
    return found.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "order", "rule", "end"))).alias("found")).select(
        "blob", F.transform("found", lambda x: F.struct(x["rule"].alias("rule"), x["start"].alias("start"), x["end"].alias("end"))).alias("spans"))


def extend_ledger(versions: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks, append it, and return the ledger.

    versions: any rows with `text`; a ledger is a folder in shared storage with one Parquet
    folder for each call, of rows (blob, scanned rule versions, spans). Copies of a text are
    one blob, merged before and in the shuffle; a blob is scanned with those rule versions
    only that no earlier call applied to it. A call that is cut short leaves no rows behind.
    """
    spark = versions.sparkSession
    path = ledger or scratch_folder(spark, "blob-ledger")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    known = spark.read.schema(LEDGER + ", batch string").parquet(path).drop("batch") if exists else spark.createDataFrame([], LEDGER)
    names = F.array(*[F.lit(r.name) for r in rules])
    done = known.select("blob", F.explode("scanned").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    blobs = versions.select(blob_id(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    distinct = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    empty = F.array().cast("array<string>")

    def unseen(frame: DataFrame) -> DataFrame:
        if not exists:
            return frame.withColumn("done", empty)
        return (frame.join(done, "blob", "left").withColumn("done", F.coalesce("done", empty))
                .where(F.size(F.array_except(names, F.col("done"))) > 0))
    spans = _spans(unseen(distinct), rules)
    new = unseen(blobs.select("blob").distinct()).join(spans, "blob", "left").select(
        "blob", F.array_except(names, F.col("done")).alias("scanned"),
        F.coalesce("spans", F.array().cast("array<struct<rule:string,start:int,end:int>>")).alias("spans"))
    new.write.parquet(f"{path}/batch={batch_name()}")
    return spark.read.schema(LEDGER + ", batch string").parquet(path).drop("batch")


def scan_secrets(versions: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob and spans (rule, kind order, start, end) of every version, sorted by start and rule order.

    `doc_id` names a version's path. Null or empty text has no span. Places count code
    points, ends are exclusive. Repeated rows give equal rows each, a null doc_id is kept,
    other columns are not read; an empty table gives no rows. Findings of other versions
    of a rule, which a ledger may hold, are left out.
    """
    known = extend_ledger(versions, ledger, rules)
    order = F.create_map(*[x for n, r in enumerate(rules) for x in (F.lit(r.name), F.lit(n))])
    # A table of its own, so that the versions of one much copied blob are split in the join.
    found = settled(known.where(F.size("spans") > 0).select("blob", F.explode("spans").alias("s")).where(
        order[F.col("s.rule")].isNotNull()).groupBy("blob").agg(F.array_sort(F.collect_list(F.struct(
            F.col("s.start").alias("start"), order[F.col("s.rule")].alias("order"), F.col("s.end").alias("end"),
            F.regexp_replace("s.rule", "@.*", "").alias("kind")))).alias("spans")), "findings")
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    return versions.select("doc_id", blob_id(F.col("text")).alias("blob")).join(found, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", none).alias("spans"))
