"""Conversations rendered by a compiled template, with a mask of what is to be learned."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow.llm.templates import compile_template
from tempoflow.session import shuffle_partitions

# Strings that a tokenizer or a reader of the output would take for control strings.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

TEMPLATE = (
    "{% for m in messages %}<|im_start|>{{ m.role | line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | guard }}{% endgeneration %}"
    "{% else %}{{ m.text | guard }}{% endif %}<|im_end|>\n{% endfor %}"
)
START, END = "<|im_start|>", "<|im_end|>\n"
PART = 16_384

PLACES = re.compile("|".join(rf"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS) + r"|\\")
UNGUARD = re.compile(r"\\(\\?)")
ROLE = re.compile(r"((?:\\.|[^\\\n])*)\n", re.S)


def guard(text: str | None) -> str:
    """A backslash after the first character of every control string, and every backslash doubled."""
    return PLACES.sub(lambda m: m[0] + "\\", text or "")


def guard_line(text: str | None) -> str:
    """As :func:`guard`, with a backslash before line ends: the result is read up to the first bare line end."""
    return guard(text).replace("\n", "\\\n")


def unguard(text: str) -> str:
    """What was guarded: of two backslashes the second stays, a single one goes."""
    return UNGUARD.sub(r"\1", text)


SCHEMA = "conv_id long, part long, text string, spans array<struct<start:int,end:int>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while chunk := list(itertools.islice(rows, 1000)):
        columns = zip(*chunk, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def render(turns: DataFrame, template: str = TEMPLATE, part: int = PART) -> DataFrame:
    """``conv_id, part, text, spans``: formatted conversations in parts of about ``part`` code points; joined in order, a
    conversation's parts are its text, and ``spans`` are the learned code points of a part.

    Turns are sorted by turn (then role and text, so that repeated turns have a defined order; nulls first) and streamed
    through the template: no conversation is held as a whole, however many rows it has. Null roles and texts are empty, turns
    without a conversation id form one conversation, other columns are ignored; no turns, no rows.
    """
    dealt = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    dealt = dealt.repartition(shuffle_partitions(turns.sparkSession), "conv_id")
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = compile_template(template, {"guard": guard, "line": guard_line})

        def parts() -> Iterator[tuple]:
            for conv, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                number, texts, spans, size = 0, [], [], 0
                for text, learned in compiled.render({"messages": ({"role": r or "", "text": t or ""} for _, r, t in group)}):
                    if learned and text:
                        spans.append({"start": size, "end": size + len(text)})
                    texts.append(text)
                    size += len(text)
                    if size >= part:
                        yield conv, number, "".join(texts), spans
                        number, texts, spans, size = number + 1, [], [], 0
                if size:
                    yield conv, number, "".join(texts), spans

        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("spans", SPANS)])
        yield from _batches(parts(), schema)

    return dealt.mapInArrow(run, SCHEMA)


def read_turns(parts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of one formatted conversation; holds one turn at a time."""
    held = ""
    for piece in parts:
        held += piece
        at = 0
        while (end := held.find(END, at)) >= 0:
            role = ROLE.match(held, at + len(START))
            yield unguard(role[1]), unguard(held[role.end() : end])
            at = end + len(END)
        held = held[at:]


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest(parts: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from :func:`render`'s output, whose partitions hold whole conversations in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for conv, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]

                def texts(group=group, loss=loss, counts=counts) -> Iterator[str]:
                    for _, _, text, spans in group:
                        for span in spans:
                            learned = unguard(text[span["start"] : span["end"]])
                            loss.update(learned.encode("utf-8", "surrogatepass"))
                            counts[1] += len(learned)
                        counts[2] += len(text)
                        yield text

                for role, text in read_turns(texts()):
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    counts[0] += 1
                yield conv, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [part.split()[0] for part in DIGEST.split(", ")]
        yield from _batches(digests(), pa.schema(list(zip(names, kinds, strict=True))))

    return parts.mapInArrow(run, DIGEST)
