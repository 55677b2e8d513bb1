"""Chat formatting: a finite-state machine over roles, driven by a declarative template.

``TEMPLATE`` names, for each role, what opens and closes a turn, whether its text is under the
loss mask, and which roles may come next; ``start`` names the roles that may begin a
conversation and ``final`` those that may end it. ``*`` stands for every other role.
Control strings in texts are escaped character by character (``\\`` before each of ``\\ < > [ ]``),
so no text can contain a mark, and the text comes back exactly.

The machine's state is the role just read, so only neighbouring turns meet. Turns are
sorted over the cluster by (conversation, turn): a conversation of any length is cut wherever a
range ends. The first turn of a partition is judged with the last role of the partition before
it, from a table of one row per partition.

Cases: null text and null role count as empty; turns sort by turn (null first), then role, then
text, repeated rows stay turns of their own; rows without conv_id form one conversation; every
conversation is formatted, ``valid`` says whether the machine accepts it; an empty table gives
an empty one; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TEMPLATE = {
    "start": ["system", "user"],
    "final": ["assistant"],
    "roles": {
        "system": {"open": "<s>[SYS] ", "close": " [/SYS]</s>\n", "loss": False, "next": ["user"]},
        "user": {"open": "<s>[INST] ", "close": " [/INST]</s>\n", "loss": False, "next": ["assistant"]},
        "assistant": {"open": "<s>[OUT] ", "close": " [/OUT]</s>\n", "loss": True, "next": ["user"]},
        "*": {"open": "<s>[ROLE {role}] ", "close": " [/ROLE]</s>\n", "loss": False, "next": []},
    },
}
SPECIAL = re.compile(r"[\\<>\[\]]")
SEGMENT = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
TURN = pa.schema([("part", pa.int32()), ("pos", pa.int64()), ("conv_id", pa.int64()), ("role", pa.string()),
                  ("first", pa.bool_()), ("ok", pa.bool_()), ("segments", SEGMENT)])
TURN_SQL = ("part int, pos long, conv_id long, role string, first boolean, ok boolean, "
            "segments array<struct<text: string, loss: boolean>>")
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def allowed(template: dict, before: str | None, role: str) -> bool:
    """Whether the machine may read ``role`` after ``before`` (None: at the start)."""
    after = template["start"] if before is None else _spec(template, before)["next"]
    return role in after


def _spec(template: dict, role: str) -> dict:
    return template["roles"].get(role) or template["roles"]["*"]


def segments(template: dict, role: str, text: str) -> list[dict]:
    """The formatted turn in pieces, each with its loss flag."""
    spec = _spec(template, role)
    return [{"text": spec["open"].replace("{role}", escape(role)), "loss": False},
            {"text": escape(text), "loss": spec["loss"]}, {"text": spec["close"], "loss": False}]


def _format(template: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pos = TaskContext.get().partitionId(), 0
        before: tuple | None = None
        for batch in batches:
            out = []
            for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                first = before is not None and before[0] != key
                ok = None if before is None else allowed(template, None if first else before[1], role)
                out.append({"part": part, "pos": pos, "conv_id": key, "role": role, "first": first, "ok": ok,
                            "segments": segments(template, role, text)})
                before, pos = (key, role), pos + 1
            yield pa.RecordBatch.from_pylist(out, TURN)
    return run


def write_chats(turns: DataFrame, out: str, template: dict = TEMPLATE) -> None:
    """Format every turn and write (part, pos, conv_id, role, first, ok, segments) to the folder ``out``.

    (part, pos) is the order of the turns; ``ok`` is null for the first turn of a part.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    by = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role")]
    # rows of one turn and role are one conversation's, which passes through one task in the end; their texts are no bounds
    (rows.repartitionByRange(*by).sortWithinPartitions(*by, F.col("text").asc_nulls_first())
     .mapInArrow(_format(template), TURN_SQL).write.parquet(out))


def validity(spark: SparkSession, path: str, template: dict = TEMPLATE) -> DataFrame:
    """(conv_id, valid): whether the machine accepts each written conversation."""
    turns = spark.read.schema(TURN_SQL).parquet(path)
    edges = turns.groupBy("part").agg(F.min(F.struct("pos", "conv_id", "role")).alias("head"),
                                      F.max(F.struct("pos", "conv_id", "role")).alias("tail"))
    before = F.lag("tail").over(Window.orderBy("part"))  # one row per partition
    heads = edges.withColumn("before", before).select(
        "part", (F.col("before").isNotNull() & F.col("before.conv_id").eqNullSafe(F.col("head.conv_id"))).alias("goes_on"),
        F.col("before.role").alias("role_before"))
    # at most one row per partition of the writing job
    told = turns.drop("segments").join(F.broadcast(heads), "part")
    pairs = F.lit(False)
    for role, spec in template["roles"].items():
        if role != "*":
            pairs = pairs | ((F.col("role_before") == role) & F.col("role").isin(spec["next"]))
    others = ~F.col("role_before").isin([r for r in template["roles"] if r != "*"])
    pairs = pairs | (others & F.col("role").isin(template["roles"]["*"]["next"]))
    ok = F.coalesce("ok", F.when(F.col("goes_on"), pairs).otherwise(F.col("role").isin(template["start"])))
    last = F.max(F.struct("part", "pos", "role"))
    return told.groupBy("conv_id").agg((F.min(ok) & last["role"].isin(template["final"])).alias("valid"))


def _reader(template: dict) -> re.Pattern:
    """A pattern over a formatted turn: named groups ``r<k>`` (a given role) and text."""
    body = r"((?:[^\\<>\[\]]|\\.)*)"
    turns = []
    for spec in template["roles"].values():
        head = re.escape(spec["open"]).replace(re.escape("{role}"), body)
        turns.append(head + body + re.escape(spec["close"]))
    return re.compile("|".join(turns), re.S)


def parse(template: dict, formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn, from its marks alone."""
    found = _reader(template).fullmatch(formatted)
    if not found:
        raise ValueError("not a formatted turn")
    groups, at = found.groups(), 0
    for role, spec in template["roles"].items():
        own = 2 if "{role}" in spec["open"] else 1
        if groups[at + own - 1] is not None:
            return (unescape(groups[at]) if own == 2 else role), unescape(groups[at + own - 1])
        at += own
    raise ValueError("not a formatted turn")


def _digests(template: dict):
    """Turns sorted by (conv_id, part, pos) to one row per conversation; a turn is held at a time."""
    names = [x.split()[0] for x in DIGEST.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def row() -> tuple:
            return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])

        for batch in batches:
            done = []
            for key, pieces in zip(batch.column("conv_id").to_pylist(), batch.column("segments").to_pylist(), strict=True):
                if state is None or state[0] != key:
                    if state is not None:
                        done.append(row())
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                formatted = "".join(p["text"] for p in pieces)
                role, text = parse(template, formatted)
                learned = "".join(unescape(p["text"]) for p in pieces if p["loss"])
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state[3] += len(learned)
                state[4].update(learned.encode("utf-8", "surrogatepass"))
                state[5] += len(formatted)
            if done:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
        if state is not None:
            yield pa.record_batch([pa.array([v], k) for v, k in zip(row(), kinds, strict=True)], names=names)
    return run


def read_digests(spark: SparkSession, path: str, template: dict = TEMPLATE) -> DataFrame:
    """What the written conversations hold, read back from their marks: one row per conversation.

    A SHA-256 over a conversation is sequential, so its turns pass through one task, one at a time.
    """
    turns = spark.read.schema(TURN_SQL).parquet(path).select("conv_id", "part", "pos", "segments")
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
            .mapInArrow(_digests(template), DIGEST))
