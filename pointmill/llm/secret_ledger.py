"""Secret scan with a ledger of what has been scanned.

Every text is a version of a blob, addressed by its SHA-256. The ledger holds a row for each
scanned (blob, kind, version of the rule), with or without findings. A run looks up which of
its blobs lack which rules, scans one row per such blob for those rules only, appends to the
ledger and joins the findings back to every row that has the blob. DataFrame functions only.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pointmill.llm.common import saved


@dataclass(frozen=True)
class Rule:
    """A match counts if group has least characters at least and the whole match begins with shape. hints: some of them stands in the lower-cased text of any match.

    A pattern should take a run it has begun to the run's end, and leave what the run must hold to shape: one that gives up at
    the end of a long run starts again at every later place.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    hints: tuple[str, ...] = ()
    version: int = 1
    shape: str = ""


# The kinds, in the order that breaks ties, and their patterns.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        ("password", "passwd", "secret", "token", "api"),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hints=("private key-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_.-]+", hints=("eyj",), version=2, shape=r"^eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE

#: New blobs up to which the texts are not shuffled to them: their list is left to Spark to broadcast.
_FEW_BLOBS = 50_000
_LEDGER = "blob string, kind string, version int, spans array<struct<start: long, end: long>>"


def _key(rule: Rule) -> str:
    return f"{rule.kind}:{rule.version}"


def _matches(rule: Rule, text: Column, small: Column) -> Column:
    """Leftmost matches in order: (characters between the one before and this, its characters, whether it counts)."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    groups = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    shaped = (lambda m: m.rlike(rule.shape)) if rule.shape else (lambda m: F.lit(True))
    lengths = F.zip_with(found, groups, lambda m, g: F.struct(F.length(m).alias("size"), ((F.length(g) >= rule.least) & shaped(m)).alias("counts")))
    each = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)),
        lengths,
        lambda gap, m: F.struct(F.length(gap).alias("gap"), m["size"].alias("size"), m["counts"].alias("counts")),
    )
    test = text.rlike(rule.pattern)
    if rule.hints:
        hinted = small.contains(rule.hints[0])
        for hint in rule.hints[1:]:
            hinted = hinted | small.contains(hint)
        test = hinted & test
    return F.when(test, each)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)


def _scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows for (blob, text, todo); todo: keys of the rules to apply."""
    small = F.lower("text")
    one = [
        F.when(
            F.array_contains("todo", _key(rule)),
            F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), _matches(rule, F.col("text"), small).alias("matches")),
        )
        for rule in rules
    ]
    # A blob that repeated rows bring twice is kept once; the findings are small.
    found = texts.select("blob", F.array_compact(F.array(*one)).alias("found")).groupBy("blob").agg(F.first("found").alias("found"))
    each = found.select("blob", F.inline("found"))
    order = Window.partitionBy("blob", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.col("size")).over(order)
    spans = each.where("size(matches) > 0").select("blob", "kind", F.posexplode("matches").alias("at", "m")).select("blob", "kind", "at", "m.*")
    spans = spans.select("blob", "kind", "size", "counts", end.alias("end")).where("counts")
    spans = spans.groupBy("blob", "kind").agg(F.array_sort(F.collect_list(F.struct((F.col("end") - F.col("size")).alias("start"), "end"))).alias("spans"))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return each.select("blob", "kind", "version").join(spans, ["blob", "kind"], "left").withColumn("spans", F.coalesce("spans", none))


def update_ledger(docs: DataFrame, ledger: str, id_column: str = "doc_id", text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at this path lacks, append it there, and return (id, blob) of each row of docs.

    NULL texts are empty texts. Repeated texts are one blob. One run writes a ledger at a time;
    if a run is repeated after a failure, rows may be in the ledger twice, with the same content.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    rows = saved(texts.select("id", "blob"), "blobs")
    wanted = F.array(*[F.lit(_key(r)) for r in rules])
    seen = read_ledger(spark, ledger).groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", F.col("version").cast("string"))).alias("seen"))
    todo = rows.groupBy("blob").agg(F.min("id").alias("id")).join(seen, "blob", "left")
    # Written, so that its size is known before the texts are joined with it.
    todo = saved(todo.select("blob", "id", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo")).where("size(todo) > 0"), "unseen")
    unseen = todo.count()
    if unseen:
        listed = todo.alias("b") if unseen <= _FEW_BLOBS else todo.alias("b").hint("shuffle_hash")
        there = texts.alias("t").join(listed, F.expr("t.blob = b.blob AND t.id <=> b.id"))
        _scan(there.select("t.blob", "t.text", "b.todo"), rules).write.mode("append").option("compression", "zstd").parquet(ledger)
    return rows


def blob_spans(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of the blobs with findings of these rules: structs (start, kind, end, base) by start, then kind in the rules' order."""
    number = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
    current = read_ledger(spark, ledger).where(F.concat_ws(":", "kind", F.col("version").cast("string")).isin([_key(r) for r in rules]))
    found = current.where("size(spans) > 0").select("blob", "kind", number[F.col("kind")].alias("k"), F.inline("spans"))
    spans = F.array_sort(F.collect_set(F.struct("start", "k", "end", "kind")))
    return found.groupBy("blob").agg(spans.alias("spans"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def secret_scan(docs: DataFrame, ledger: str, id_column: str = "doc_id", text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of docs: id, n_<kind> for each base kind, base_sha256, spans, n_spans, blob.

    Positions are code points, ends exclusive. Rows with NULL or empty text have no spans; repeated rows are reported each.
    """
    rows = update_ledger(docs, ledger, id_column, text_column, rules)
    found = rows.join(blob_spans(docs.sparkSession, ledger, rules), "blob", "left")
    kinds = [r.kind for r in BASE]
    spans = F.coalesce("spans", F.array().cast("array<struct<start: bigint, k: int, end: bigint, kind: string>>"))
    found = found.select("id", "blob", spans.alias("spans"))
    return found.select(
        F.col("id").alias(id_column),
        *[F.size(_of(F.col("spans"), kind)).cast("long").alias(f"n_{kind}") for kind in kinds],
        F.sha2(_written(_of(F.col("spans"), *kinds)), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        "blob",
    )


def redact(docs: DataFrame, ledger: str, id_column: str = "doc_id", text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with every span of a secret replaced by [kind]; overlapping spans become the first one's mask. Columns stay as they were."""
    update_ledger(docs, ledger, id_column, text_column, rules)
    held = docs.select(F.struct("*").alias("_doc"), F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256).alias("_blob"))
    found = blob_spans(docs.sparkSession, ledger, rules).select(F.col("blob").alias("_found"), F.col("spans").alias("_spans"))
    text = F.col(f"_doc.{text_column}")
    # A span that begins before an earlier one has ended belongs to that one's mask.
    each = found.select("_found", F.inline("_spans"))
    before = F.max("end").over(Window.partitionBy("_found").orderBy("start", "k").rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("past", F.coalesce(before, F.lit(0).cast("long")))
    fresh = F.when(F.col("start") >= F.col("past"), F.struct("start", "past", "kind"))
    found = each.groupBy("_found").agg(F.array_sort(F.collect_list(fresh)).alias("_spans"), F.max("end").alias("_end"))

    def piece(s: Column) -> Column:
        return F.concat(F.substring(text, (s["past"] + 1).cast("int"), (s["start"] - s["past"]).cast("int")), F.lit("["), s["kind"], F.lit("]"))

    masked = F.concat(F.array_join(F.transform("_spans", piece), ""), F.substring(text, (F.col("_end") + 1).cast("int"), F.length(text)))
    joined = held.join(found.hint("shuffle_hash"), F.col("_blob") == F.col("_found"), "left")
    new = F.col("_doc").withField(text_column, F.when(F.col("_spans").isNull(), text).otherwise(masked))
    return joined.select(new.alias("_doc")).select("_doc.*")
