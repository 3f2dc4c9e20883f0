"""Secret scanning with an incremental blob ledger.

Every version of a path (here: every document row) is addressed by the SHA-256 of its content. The ledger, a Parquet
table in shared storage, holds one row for each scan of a blob: the blob, the rules with their versions that were
applied, and the findings. A run looks up which (blob, rule version) pairs the ledger lacks, scans just those, each
blob once however many paths carry it, appends them, and joins the findings back to all paths. A new rule or a raised
rule version makes only that rule run over old blobs.

Copies are dropped in each task before texts are shuffled by content, so a blob with very many copies costs one text
for each task; the join back is on the blob and is split by the skew-join rule.

Defined cases: a null text is an empty text; repeated rows give repeated results; an empty table gives an empty
result; a scan that is repeated after a failure adds the same findings, which count once. Only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varsift.llm.arrow_jobs import strings
from varsift.llm.storage import shared_path, unused
from varsift.llm.text_arrays import utf8

LEDGER = "blob string, rules array<string>, spans array<struct<kind:string,start:int,end:int>>"
Span = tuple[int, int]


@dataclass(frozen=True)
class Rule:
    """A kind of secret: quick substrings of which a text must hold one (lower-cased), a pattern, a test of a match."""

    kind: str
    version: int
    hints: tuple[str, ...]
    pattern: str
    accept: Callable[[re.Match], bool] = lambda m: True

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The first three are the fixed base patterns; the rest is the operator's own.
RULES = (
    Rule("assign", 1, ("password", "passwd", "secret", "token", "api"),
         r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
         lambda m: len(m[2]) >= 6),
    Rule("access", 1, ("akia",), r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, (), r"[0-9a-f]{24,}"),
    Rule("key_block", 1, ("private key",), r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?"),
    Rule("web_token", 1, ("eyj",), r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", 1, ("bearer",), r"(?ai:bearer)\x20+[A-Za-z0-9._~+/-]{16,}=*"),
    Rule("url_login", 1, ("://",), r"(?<=://)[^\s/:@]{1,64}:[^\s/:@]{1,128}(?=@)"),
)
BASE = ("assign", "access", "hex")


def scan(text: str, rules: list[tuple[Rule, re.Pattern]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points by start, then as the rules are listed."""
    lower, out = text.lower(), []
    for k, (rule, pattern) in enumerate(rules):
        if not rule.hints or any(h in lower for h in rule.hints):
            out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if rule.accept(m)]
    return [(rules[k][0].kind, a, b) for a, k, b in sorted(out)]


def _scan_job(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {r.name: (r, re.compile(r.pattern)) for r in rules}
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                wanted = part.column(2).to_pylist()
                found = [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t, [compiled[n] for n in names])]
                         for t, names in zip(strings(*utf8(part.column(1))), wanted, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(found, span)], ["blob", "rules", "spans"])

    return run


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``blob``, ``spans`` (kind, start, end; code points). Updates the ledger at that path."""
    spark = docs.sparkSession
    names = [r.name for r in rules]
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    texts = texts.withColumn("blob", F.sha2("_text", 256))
    past = read_ledger(spark, ledger)
    applied = past.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("applied"))
    versions = texts.select("blob", "_text").dropDuplicates(["blob"])
    unseen = versions.join(applied, "blob", "left").select(
        "blob", "_text", F.array_except(F.array(*map(F.lit, names)), F.coalesce("applied", F.expr("cast(array() as array<string>)"))).alias("rules"))
    unseen.where(F.size("rules") > 0).mapInArrow(_scan_job(rules), LEDGER).write.mode("append").parquet(ledger)
    kinds = [r.kind for r in rules]
    order = F.array(*map(F.lit, kinds))
    made = f"element_at(filter(rules, r -> substring_index(r, '@', 1) = s.kind), 1) in ({', '.join(map(repr, names))})"
    current = read_ledger(spark, ledger).select("blob", "rules", F.explode("spans").alias("s")).where(made)
    spans = current.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct(
        F.col("s.start"), F.array_position(order, F.col("s.kind")).alias("k"), F.col("s.end"), F.col("s.kind")))).alias("x"))
    spans = spans.select("blob", F.expr("transform(x, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end))").alias("spans"))
    nothing = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    return texts.select(id_col, "blob").join(spans.hint("rebalance"), "blob", "left").select(id_col, "blob", F.coalesce("spans", nothing).alias("spans"))


def read_ledger(spark, ledger: str) -> DataFrame:
    """The ledger's rows; none if there is no ledger yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def without_secrets(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text",
                    mask: str = "[secret]") -> DataFrame:
    """The documents with every found span replaced by ``mask``; other columns as they are."""
    found = findings(docs, ledger, id_col=id_col, text_col=text_col).where(F.size("spans") > 0).select("blob", "spans").distinct()
    blob, spanned = unused(docs, "_blob", "_spans")
    own = docs.withColumn(blob, F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
    own = own.join(found.withColumnsRenamed({"blob": blob, "spans": spanned}), blob, "left")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.num_columns - 1)
            text = batch.column(at).to_pylist() if spans.null_count < len(spans) else None
            columns = list(batch.columns[:-1])
            if text:
                for k, own in enumerate(spans.to_pylist()):
                    if own:
                        text[k] = masked(text[k], [(s["start"], s["end"]) for s in own], mask)
                columns[at] = pa.array(text, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([batch.schema.field(i) for i in range(batch.num_columns - 1)]))

    return own.select(*[F.col(f"`{c}`") for c in docs.columns], spanned).mapInArrow(run, docs.schema)


def masked(text: str, spans: list[Span], mask: str) -> str:
    """The text with each maximal run of spans replaced."""
    out, till = [], 0
    for a, b in sorted(spans):
        if a >= till:
            out += [text[till:a], mask]
        till = max(till, b)
    return "".join([*out, text[till:]])


def contract(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """The columns of op8, with a new ledger unless one is given."""
    found = findings(docs, ledger or shared_path(docs.sparkSession, "ledger"))
    return joined_spans(found, BASE)


def joined_spans(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """Counts and joined texts of ``spans``: kind:start:end, by comma."""
    line = "concat_ws(',', transform({}, s -> concat_ws(':', s.kind, s.start, s.end)))"
    chosen = "filter(spans, s -> s.kind in ({}))".format(", ".join(f"'{k}'" for k in base))
    return found.select(
        "doc_id", *[F.size(F.expr(f"filter(spans, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(F.expr(line.format(chosen)), 256).alias("base_sha256"), F.expr(line.format("spans")).alias("spans"))
