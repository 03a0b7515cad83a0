"""Chat formatting: conversations to marked text segments with loss flags, and back.

A declarative template names the marks, the roles that the loss covers and a finite-state
machine over roles. Rows are range-partitioned by (conversation, turn), so a conversation that
holds a third of all turns is cut into slices over many tasks. Each task runs the machine over its
slice; where a slice may begin in the middle of a conversation, it runs it from every state at
once, and the states that slices really begin in follow from one row a slice.
"""

from __future__ import annotations

import dataclasses
import hashlib
import itertools
import re
from collections.abc import Iterator, Mapping
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import text_or_empty, write_scratch


@dataclasses.dataclass(frozen=True)
class Template:
    """Marks, loss and turn order.

    A turn is ``open`` + role + ``between`` + text + ``close``. ``open`` and ``close`` begin with
    the two characters ``lead``, as all control strings do. ``steps`` has, for each state, the
    state that a role leads to; any other turn is out of order, and the machine goes on
    in the role's own state, or in ``start`` for a role without one.
    """

    open: str
    between: str
    close: str
    lead: str
    loss: frozenset[str]
    start: str
    steps: Mapping[str, Mapping[str, str]]

    def __post_init__(self):
        if len(self.lead) != 2 or not (self.open.startswith(self.lead) and self.close.startswith(self.lead)):
            raise ValueError("open and close must begin with the two characters of lead")

    @property
    def states(self) -> list[str]:
        return sorted(self.steps)

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """(next state, whether the role may follow)."""
        allowed = self.steps[state].get(role)
        if allowed is not None:
            return allowed, True
        return (role if role in self.steps else self.start), False

    def escape(self, text: str) -> str:
        """No ``lead`` is left: a backslash goes between its characters, one more if some are there."""
        a, b = map(re.escape, self.lead)
        return re.sub(rf"{a}(\\*){b}", lambda m: self.lead[0] + "\\" + m[1] + self.lead[1], text) if self.lead[0] in text else text

    def unescape(self, text: str) -> str:
        a, b = map(re.escape, self.lead)
        return re.sub(rf"{a}\\(\\*){b}", lambda m: self.lead[0] + m[1] + self.lead[1], text) if self.lead[0] in text else text

    def escape_role(self, role: str) -> str:
        """As a text, and without ``between``."""
        marked = self.between[0]
        return self.escape(role.replace("%", "%25").replace(marked, f"%{ord(marked):02x};"))

    def unescape_role(self, role: str) -> str:
        marked = self.between[0]
        return self.unescape(role).replace(f"%{ord(marked):02x};", marked).replace("%25", "%")

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, whether the loss covers it), in order."""
        return [(self.open + self.escape_role(role) + self.between, False), (self.escape(text), role in self.loss), (self.close, False)]

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """(role, text) of every turn of a formatted text, which must hold whole turns."""
        end = 0
        while end < len(formatted):
            if not formatted.startswith(self.open, end):
                raise ValueError(f"no turn at character {end}")
            begin = formatted.index(self.between, end + len(self.open))
            stop = formatted.index(self.close, begin + len(self.between))
            yield self.unescape_role(formatted[end + len(self.open) : begin]), self.unescape(formatted[begin + len(self.between) : stop])
            end = stop + len(self.close)


#: The marks of the widespread form with im_start and im_end, and its turn order.
CHATML = Template(
    open="<|im_start|>",
    between="\n",
    close="<|im_end|>\n",
    lead="<|",
    loss=frozenset({"assistant"}),
    start="begin",
    steps={
        "begin": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    },
)

SEGMENT = T.StructType([T.StructField("text", T.StringType()), T.StructField("loss", T.BooleanType())])


def format_conversations(
    rows: DataFrame,
    template: Template = CHATML,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row a turn: conversation, ``at`` (from 0), ``segments`` (text, loss), ``in_order``, ``state`` after it.

    Defined results: a null text is empty and a null role is the empty role; roles that the
    template doesn't know are formatted like others, without loss, and are out of order; turns
    are ordered by ``turn``, null first, and among equal ones by role and text, so repeated
    rows are turns of their own; rows with a null conversation id are one conversation; an empty
    table gives an empty result; other columns are left alone. Control strings inside roles
    and texts are escaped reversibly (``Template.turns`` undoes it). A turn out of order is
    marked, not dropped.
    """
    spark = rows.sparkSession
    kind = rows.schema[conv_col].dataType
    turns = rows.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), text_or_empty(F.col(f"`{role_col}`")).alias("role"), text_or_empty(F.col(f"`{text_col}`")).alias("text")
    )
    schema = T.StructType(
        [
            T.StructField("conv", kind),
            T.StructField("slice", T.IntegerType()),
            T.StructField("first", T.BooleanType()),  # the slice's first conversation, which may have begun before
            T.StructField("at", T.LongType()),
            T.StructField("segments", T.ArrayType(SEGMENT)),
            T.StructField("states", T.ArrayType(T.StringType())),  # after the turn, by the state before the slice; one entry if that is known
            T.StructField("orders", T.ArrayType(T.BooleanType())),
        ]
    )
    names = template.states

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, first, at, states = TaskContext.get().partitionId(), None, None, 0, []
        for batch in batches:
            out = {f.name: [] for f in schema}
            for conv, role, text in zip(batch.column("conv").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                if first is None or conv != now:
                    first, now, at = first is None, conv, 0
                    states = names if first else [template.start]
                states, orders = zip(*[template.step(s, role) for s in states])
                segments = [{"text": t, "loss": loss} for t, loss in template.segments(role, text)]
                for name, value in zip(out, (conv, part, first, at, segments, list(states), list(orders))):
                    out[name].append(value)
                at += 1
            types = [batch.schema.field("conv").type, pa.int32(), pa.bool_(), pa.int64(), pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])), pa.list_(pa.string()), pa.list_(pa.bool_())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=schema.names)

    # the hash deals rows that share a conversation and a turn out over slices as well
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text"), F.col("text")]
    walked = write_scratch(turns.repartitionByRange(*order[:4]).sortWithinPartitions(*order).mapInArrow(walk, schema), "chat")

    # two rows a slice: how its first conversation and its last one end there (null ids are always first)
    by_slice = lambda rows, *order: {r["slice"]: r["end"] for r in rows.groupBy("slice").agg(F.max(F.struct(*order)).alias("end")).collect()}
    heads = by_slice(walked.where("first"), "at", "conv", "states")
    tails = by_slice(walked.where(~F.col("first")), "conv", "at", "states")
    begins, carried = [], None  # (conversation, turns so far, state) at the end of the slice before
    for s in sorted(heads):
        head, tail = heads[s], tails.get(s)
        before, state = (carried[1], carried[2]) if carried and carried[0] == head["conv"] else (0, template.start)
        begins.append((s, before, names.index(state)))
        carried = (head["conv"], before + head["at"] + 1, head["states"][names.index(state)])
        if tail:
            carried = (tail["conv"], tail["at"] + 1, tail["states"][0])
    known = spark.createDataFrame(begins, "slice int, before long, entry int")
    own = F.when(F.col("first"), F.col("entry")).otherwise(F.lit(0))
    # a row for each slice, as many as the range exchange has partitions
    return walked.join(F.broadcast(known), "slice").select(
        F.col("conv").alias(conv_col),
        (F.col("at") + F.when(F.col("first"), F.col("before")).otherwise(F.lit(0))).alias("at"),
        "segments",
        F.get("orders", own).alias("in_order"),
        F.get("states", own).alias("state"),
    )


def read_back(formatted: DataFrame, template: Template = CHATML, conv_col: str = "conv_id") -> DataFrame:
    """One row a conversation, parsed from the formatted text and its loss flags.

    (conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). The digests run
    over a conversation's turns in order, so its turns meet in one task; they are streamed, and
    a task holds one batch whatever a conversation's length.
    """
    kind = formatted.schema[conv_col].dataType
    schema = T.StructType(
        [
            T.StructField("conv", kind),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
            T.StructField("n_out_of_order", T.LongType()),
        ]
    )

    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        def rows():
            for batch in batches:
                yield from batch.to_pylist()

        for conv, own in itertools.groupby(rows(), itemgetter("conv")):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = wrong = 0
            for r in own:
                text = "".join(s["text"] for s in r["segments"])
                chars, wrong = chars + len(text), wrong + (not r["in_order"])
                for role, turn in template.turns(text):
                    n_turns += 1
                    turns.update(f"{role}\n{turn}\n".encode())
                for s in r["segments"]:
                    if s["loss"]:
                        plain = template.unescape(s["text"])
                        loss_chars += len(plain)
                        loss.update(plain.encode())
            yield (conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, wrong)

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = read(batches)
        while some := list(itertools.islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), arrow)], schema=arrow)

    needed = formatted.select(F.col(f"`{conv_col}`").alias("conv"), "at", "segments", "in_order")
    dealt = needed.repartition("conv").sortWithinPartitions("conv", "at")
    return dealt.mapInArrow(batched, schema).withColumnRenamed("conv", conv_col)
