"""Secret scan with linking of multipart credentials.

A scan of every whole text finds the base kinds, which always count, and weak
candidates: short secrets, account names and endpoints, each meaningless alone.
An interval join decides on the candidates. Every part, base or weak, covers cells
of ``SCOPE`` code points; a candidate looks for parts in the cells that its span
reaches when widened by ``SCOPE``, and a part at most that far away is in its
scope. A candidate is reported when the parts that complete it are there:

    ident     needs a secret
    weak      needs an identifier or an endpoint
    endpoint  needs an identifier and a secret

Cells bound the partners of a candidate by the text they can hold, so no document,
however long, is joined with itself pair by pair.

Defined results: a null text is an empty one, without spans; a null id is kept;
repeated rows give repeated rows; an empty table gives an empty result. Columns
besides id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import own_columns, small_batches, stage

SCOPE = 200
KINDS = ["assign", "access", "hex", "ident", "weak", "endpoint"]
ROLES = {"assign": "secret", "weak": "secret", "hex": "secret", "access": "identifier", "ident": "identifier", "endpoint": "endpoint"}

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_WORD = re.compile("passw|secret|token|api_?key", re.ASCII | re.IGNORECASE)
ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
# A run of these characters is one match, so asking for 16 drops exactly the short ones.
HEX = re.compile("[0-9a-f]{16,}")
IDENT = re.compile(
    r"""(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{3,})""",
    re.ASCII | re.IGNORECASE,
)
ENDPOINT = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x00-\x20"'<>]{4,}""")
SECRET_CHARS, WEAK_CHARS = 12, 6

SCANNED = (
    "key string, doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
    "base array<struct<start:bigint,stop:bigint,kind:int>>, weak array<struct<start:bigint,stop:bigint,kind:int>>"
)
SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.int32())])


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{stop}" for start, stop, kind in spans)


def scan(text: str) -> tuple[list, list]:
    """Base spans and weak candidates as (start, stop, kind), each by start, then kind."""
    base, weak = [], []
    if (":" in text or "=" in text) and ASSIGN_WORD.search(text):
        for match in ASSIGN.finditer(text):
            size = match.end(2) - match.start(2)
            if size >= SECRET_CHARS:
                base.append((*match.span(), 0))
            elif size >= WEAK_CHARS:
                weak.append((*match.span(), 4))
    if "AKIA" in text:
        base += [(*match.span(), 1) for match in ACCESS.finditer(text)]
    base += [(*match.span(), 2) for match in HEX.finditer(text)]
    base.sort(key=lambda span: (span[0], span[2]))
    if ":" in text or "=" in text:
        weak += [(*match.span(), 3) for match in IDENT.finditer(text)]
    if "://" in text:
        weak += [(*match.span(), 5) for match in ENDPOINT.finditer(text)]
    return base, sorted(outside(weak, base), key=lambda span: (span[0], span[2]))


def outside(weak: list, base: list) -> list:
    """The candidates that overlap no base span; base spans are sorted by start."""
    starts, reach = [span[0] for span in base], list(accumulate((span[1] for span in base), max))
    before = [bisect_left(starts, span[1]) for span in weak]
    return [span for span, count in zip(weak, before) if not count or reach[count - 1] <= span[0]]


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, doc, texts = batch.columns
        found = [scan(text or "") for text in texts.to_pylist()]
        counts = [[sum(span[2] == kind for span in base) for base, _ in found] for kind in range(3)]
        yield pa.RecordBatch.from_arrays(
            [
                key, doc, *(pa.array(column, pa.int64()) for column in counts),
                pa.array([hashlib.sha256(named(base).encode()).hexdigest() for base, _ in found], pa.string()),
                *(pa.array([[dict(zip(("start", "stop", "kind"), span)) for span in spans] for spans in column], pa.list_(SPAN))
                  for column in ([base for base, _ in found], [weak for _, weak in found])),
            ],
            names=["key", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "weak"],
        )


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its base spans and weak candidates; ``key`` stands for id and text."""
    small_batches(docs.sparkSession)
    doc, text = F.col(id_col).cast("bigint"), F.col(text_col).cast("string")
    return docs.select(row_key(doc, text).alias("key"), doc.alias("doc_id"), text.alias("text")).mapInArrow(scan_batches, SCANNED)


def row_key(doc, text):
    """A key for id and text, the same for repeated rows only."""
    return F.concat_ws(":", doc.cast("string"), F.hex(F.xxhash64(text)), F.length(text).cast("string"))


def cells(first, last):
    return F.explode(F.sequence(F.floor(first / SCOPE), F.floor(last / SCOPE)))


def linked(scanned: DataFrame) -> DataFrame:
    """The candidates that are complete: key, start, stop, kind."""
    role = F.element_at(F.array(*(F.lit(ROLES[kind]) for kind in KINDS)), F.col("part.kind") + 1)
    with_candidates = scanned.where(F.size("weak") > 0).select("key", "base", "weak").dropDuplicates(["key"])
    parts = with_candidates.select("key", F.explode(F.concat("base", "weak")).alias("part"))
    parts = parts.select("key", "part.*", role.alias("role")).select(
        "key", "role", F.col("start").alias("p_start"), F.col("stop").alias("p_stop"),
        cells(F.col("start"), F.col("stop") - 1).alias("cell"),
    )
    candidates = with_candidates.select("key", F.explode("weak").alias("part")).select("key", "part.*")
    reach = candidates.select(
        "*", cells(F.greatest(F.col("start") - SCOPE, F.lit(0)), F.col("stop") + SCOPE).alias("cell")
    )
    near = reach.join(parts, ["key", "cell"]).where(
        (F.col("p_start") <= F.col("stop") + SCOPE) & (F.col("p_stop") >= F.col("start") - SCOPE)
    )
    present = {name: F.max((F.col("role") == name).cast("int")) == 1 for name in ("secret", "identifier", "endpoint")}
    flags = near.groupBy("key", "start", "stop", "kind").agg(*(flag.alias(name) for name, flag in present.items()))
    return flags.where(
        F.expr("kind = 3 and secret or kind = 4 and (identifier or endpoint) or kind = 5 and identifier and secret")
    ).select("key", "start", "stop", "kind")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of base kinds, checksum of base spans, and all spans that count.

    ``secrets`` lists every span as (start, stop, kind); ``spans`` has them as text.
    """
    kinds = F.array(*(F.lit(kind) for kind in KINDS))
    span_text = F.transform("secrets", lambda span: F.concat_ws(":", F.element_at(kinds, span.kind + 1), span.start, span.stop))
    return with_spans(stage(scan_documents(docs, id_col, text_col), "secret-scan")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(span_text, ",").alias("spans"), "n_linked", "secrets"
    )


def with_spans(scanned: DataFrame) -> DataFrame:
    """The scanned rows with ``secrets``, base and linked spans by start, and the number of linked ones."""
    added = linked(scanned).groupBy("key").agg(F.collect_list(F.struct("start", "stop", "kind")).alias("added"))
    none = F.array().cast("array<struct<start:bigint,stop:bigint,kind:int>>")
    ordered = F.transform(
        F.concat("base", F.coalesce("added", none)),
        lambda span: F.struct(span.start.alias("start"), span.kind.alias("kind"), span.stop.alias("stop")),
    )
    number = F.coalesce(F.array_size("added"), F.lit(0)).cast("bigint")
    return scanned.join(added, "key", "left").withColumn("secrets", F.array_sort(ordered)).withColumn("n_linked", number)


def complete_in_text(base: list, weak: list) -> list:
    """The candidates whose missing parts the text has at all, wherever: of the others none can be linked."""
    here = {ROLES[KINDS[span[2]]] for span in [*base, *weak]}
    needs = {3: {"secret"} <= here, 4: "identifier" in here or "endpoint" in here, 5: {"identifier", "secret"} <= here}
    return [span for span in weak if needs[span[2]]]


def mask_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The frame with every span of the texts replaced by its kind; ``length_col``, if given, has the new number of characters.

    The scan masks a text at once, unless it has weak candidates and parts that might complete them. Only
    such documents join their linked spans, by key, and are masked after that.
    """
    small_batches(docs.sparkSession)
    names, at = docs.columns, docs.columns.index(text_col)
    inner = [f"c{place}" for place in range(len(names))]
    key = row_key(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    keyed = docs.select(*own_columns(docs), key).toDF(*inner, "key")
    spans = "array<struct<start:bigint,stop:bigint,kind:int>>"
    columns_only = [T.StructField(name, field.dataType) for name, field in zip(inner, docs.schema)]
    masked_schema = T.StructType(list(columns_only)).add("changed", "boolean")
    scanned_schema = T.StructType(list(columns_only)).add("changed", "boolean").add("key", "string").add("base", T.DataType.fromDDL(spans)).add("weak", T.DataType.fromDDL(spans))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, bases, weaks = [], [], []
            for text in batch.column(at).to_pylist():
                base, weak = scan(text or "")
                weak = complete_in_text(base, weak)
                waits = bool(weak)
                texts.append(text if waits or not base else mask(text, [dict(zip(("start", "stop", "kind"), span)) for span in base]))
                bases.append([dict(zip(("start", "stop", "kind"), span)) for span in base] if waits else [])
                weaks.append([dict(zip(("start", "stop", "kind"), span)) for span in weak])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            changed = pa.array([found != text for found, text in zip(texts, batch.column(at).to_pylist())], pa.bool_())
            arrays = [*columns[:-1], changed, columns[-1], pa.array(bases, pa.list_(SPAN)), pa.array(weaks, pa.list_(SPAN))]
            yield pa.RecordBatch.from_arrays(arrays, names=scanned_schema.names)

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[: len(inner)])
            found = batch.column(len(inner)).to_pylist()
            columns[at] = pa.array([mask(text, spans) for text, spans in zip(batch.column(at).to_pylist(), found)], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array([bool(spans) for spans in found], pa.bool_())], names=masked_schema.names)

    rows = stage(keyed.mapInArrow(scanned, scanned_schema), "secret-scan")
    waiting = with_spans(rows.where(F.size("weak") > 0)).select(*inner, "secrets").mapInArrow(masked, masked_schema)
    done = rows.where(F.size("weak") == 0).select(*masked_schema.names).unionByName(waiting)
    if length_col is not None:
        column = inner[names.index(length_col)]
        length = F.length(inner[at]).cast(docs.schema[length_col].dataType)
        done = done.withColumn(column, F.when(F.col("changed"), length).otherwise(F.col(column)))
    return done.select(*inner).toDF(*names)


def mask(text: str, spans: list) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for span in spans:
        start, kind, stop = span["start"], span["kind"], span["stop"]
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])
