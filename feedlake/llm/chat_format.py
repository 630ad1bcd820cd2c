"""Chat formatting of turns whose content is a list of typed parts.

A visitor flattens the parts of a turn in order: text is escaped and copied, and an image, audio or document part becomes
a placeholder with its ordinal in the turn, its reference and the tokens it expands to recorded as an attachment. The
template marks a turn as `<|im_start|>role`, newline, content, `<|im_end|>`, newline. Control strings begin with `<|`;
inside a text every `<`, any backslashes, `|` gets one backslash more, so that no text can hold a control string
and the way back is exact.

The formatted output is one row per turn, in order of conversation and turn, so that a conversation of any length is
never held as a whole. Digests of conversations are folded turn by turn over sorted rows.

Null texts and null roles are empty; a null part list has no parts, and a part of an unknown kind, or null, is empty text.
Turns with equal numbers follow by role and text; repeated rows are repeated turns; turns with a null number come first.
Rows with a null conversation form one conversation. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm import arrow

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PARTS = f"array<{PART}>"


@dataclass(frozen=True)
class Expansion:
    """Tokens that attachments expand to: per image patch of so many pixels, per second of audio, per document page."""

    patch_pixels: int = 28
    audio_tokens_per_second: float = 25.0
    tokens_per_page: int = 1024


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    """A role without line ends and bars: `\\\\`, `\\n` and `\\p` stand for backslash, line end and bar."""
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("|"), F.lit("\\p"))


def text_parts(text: Column) -> Column:
    """A plain text as the only part of a turn."""
    missing = F.lit(None)
    part = F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), missing.cast("string").alias("ref"),
        missing.cast("int").alias("width"), missing.cast("int").alias("height"), missing.cast("double").alias("seconds"),
        missing.cast("int").alias("pages"),
    )
    return F.array(part).cast(PARTS)


def _expanded(part: Column, expansion: Expansion) -> Column:
    def patches(side: str) -> Column:
        return F.ceil(F.coalesce(part[side], F.lit(0)) / expansion.patch_pixels)

    return (
        F.when(part["kind"] == "image", patches("height") * patches("width"))
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * expansion.audio_tokens_per_second))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * F.lit(expansion.tokens_per_page))
        .cast("long")
    )


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"].isin("image", "audio", "document"), F.lit(False))


def format_turns(turns: DataFrame, expansion: Expansion = Expansion()) -> DataFrame:
    """One row per turn of (conv_id, turn, role, parts): its role, its formatted text, its attachments and its loss mask.

    formatted: the turn with its control strings. attachments: ordinal, kind, reference and expanded tokens in order.
    expanded_tokens: their sum. loss_start, loss_chars: the code points of `formatted` that are learned, the content of
    an assistant's turn, or 0 characters of any other.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(PARTS))
    flat = F.transform(
        parts,
        lambda part, at: F.struct(
            _is_attachment(part).alias("attached"), part.alias("part"),
            F.size(F.filter(F.slice(parts, 1, at + 1), _is_attachment)).alias("ordinal"),
        ),
    )
    visited = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), flat.alias("flat")
    )
    content = F.array_join(
        F.transform(
            "flat",
            lambda x: F.when(x["attached"], F.format_string("<|%s_%d|>", x["part"]["kind"], x["ordinal"])).otherwise(
                escaped(F.coalesce(x["part"]["text"], F.lit("")))
            ),
        ),
        "",
    )
    attachments = F.transform(
        F.filter("flat", lambda x: x["attached"]),
        lambda x: F.struct(
            x["ordinal"].alias("ordinal"), x["part"]["kind"].alias("kind"), x["part"]["ref"].alias("ref"),
            _expanded(x["part"], expansion).alias("tokens"),
        ),
    )
    made = visited.select(
        "conv_id", "turn", "role", content.alias("content"), attachments.alias("attachments"),
        F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")).alias("head"),
    )
    return made.select(
        "conv_id", "turn", "role", F.concat("head", "content", F.lit(f"{END}\n")).alias("formatted"), "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda total, x: total + x["tokens"]).alias("expanded_tokens"),
        F.length("head").cast("long").alias("loss_start"),
        F.when(F.col("role") == "assistant", F.length("content")).otherwise(0).cast("long").alias("loss_chars"),
    )


_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE = re.compile(r"\\(.)")
_TURN = re.compile(re.escape(START) + "([^\n|]*)\n(.*)" + re.escape(END) + "\n", re.DOTALL)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def read_back(formatted: str) -> tuple[str, str]:
    """Role and content of a formatted turn."""
    role, content = _TURN.fullmatch(formatted).groups()
    return _ROLE.sub(lambda found: {"n": "\n", "p": "|"}.get(found[1], found[1]), role), unescaped(content)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted turns in order.

    turns_sha256 is over role, line end, text, line end of each turn; loss_sha256 over the unescaped characters
    under the loss mask. Rows are sorted within partitions and folded one by one, whatever a conversation's length.
    """
    ddl = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, expanded_tokens long"

    schema = arrow.arrow_schema(ddl)

    def fold(batches):
        rows: list[dict] = []
        key, row = object(), {}
        turns = loss = None

        def closed() -> None:
            if row:
                rows.append(row | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()})

        for batch in batches:
            for conv_id, text, start, chars, attached, tokens in zip(*(column.to_pylist() for column in batch.columns)):
                if conv_id != key:
                    closed()
                    key, turns, loss = conv_id, hashlib.sha256(), hashlib.sha256()
                    row = {"conv_id": conv_id, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "n_attachments": 0, "expanded_tokens": 0}
                role, content = read_back(text)
                learned = unescaped(text[start : start + chars])
                turns.update(f"{role}\n{content}\n".encode())
                loss.update(learned.encode())
                row["n_turns"] += 1
                row["loss_chars"] += len(learned)
                row["formatted_chars"] += len(text)
                row["n_attachments"] += attached
                row["expanded_tokens"] += tokens
            if len(rows) >= 1024:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        closed()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    columns = formatted.select(
        "conv_id", "formatted", "loss_start", "loss_chars", F.size("attachments").alias("n_attachments"), "expanded_tokens", "turn", "role"
    )
    # Equal numbers are put in order by what the turns say, not by how it is escaped; a turn ends with END and a line end.
    content = F.col("formatted").substr(F.col("loss_start").cast("int") + 1, F.length("formatted") - F.col("loss_start").cast("int") - len(END) - 1)
    ordered = columns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", F.regexp_replace(content, r"<\\(\\*)\|", r"<$1|"))
    return ordered.drop("turn", "role").mapInArrow(fold, ddl)
