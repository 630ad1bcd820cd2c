"""Conversation structure repair over a suffix-shared DAWG of role and fault signatures.

A conversation's signature has one symbol per row: `x` for a row that must go, else the role's initial, a capital if the
text is cut off. Conversations share endings, so signatures are minimised from the end: every ending is one node of an
acyclic word graph, with one edge to the ending that is one symbol shorter. Distinct signatures are dealt by ranges of
their reversed symbols and sorted, so that a task meets all signatures of an ending one after another: it keeps the nodes of the
current signature as a stack, and the next signature adds nodes only where it leaves the common ending. Cost-to-go and the
first letter of the best audit are computed once per node and state of the grammar `(s?(ua)+)?`; the rest of
the audit is that of the node which the letter leads to. A node is made again only in a task whose range begins within its ending.
A task holds the nodes of one signature, and any number of conversations with one signature is one row.

Edits and costs: Keep 0, Rerole to user or assistant 3, Delete 4, Insert an empty user or assistant turn 3; a row that is cut off and
stays adds 3. Of audits that cost the same, the least in ASCII order is taken; an audit fixes the repaired roles.

Turns are taken by number, nulls first, then by role and text; repeated rows are duplicates of one another. Null roles and
texts are one space, so that such a text is blank. A role other than the three has an initial that no conversation allows, and so
has an empty one. Rows with a null conversation form one conversation. A conversation of any length is streamed past, never held:
only its signature and audit are, one letter per row. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm import arrow
from feedlake.llm.tables import written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
CUT_OFF = 3
#: White space of the contract, and the ends of a finished text.
WHITE, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")
#: States of the grammar: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn with such an initial.
AFTER = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
#: The state after a user's or an assistant's turn, whichever may come next; its role.
NEXT, NAMES = [USER, USER, ASSISTANT, USER], {USER: "user", ASSISTANT: "assistant"}
ACCEPTED = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}


def _null_safe(left: DataFrame, right: DataFrame, name: str) -> Column:
    return left[name].eqNullSafe(right[name])


def rows_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone, initial, fault, said, later) of every row.

    `turns` has conv_id, turn, role, text and perhaps `gone`, which marks rows that only say that a conversation exists. `fault` is blank,
    truncated or empty; `later` says that the conversation has the same role and text under a smaller number.
    """
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in turns.columns else F.lit(False)
    plain = turns.select(
        *(F.col(name).cast("long").alias(name) for name in ("conv_id", "turn")), *(F.coalesce(name, F.lit(" ")).alias(name) for name in ("role", "text")), gone.alias("gone")
    )
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    initial = F.substring("role", 1, 1)
    told = plain.select(
        "*",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        F.when(last == "", "blank").when(~last.isin(*ENDS), "truncated").otherwise("").alias("fault"),
        F.unhex(F.sha2(F.concat_ws("\x00", F.octet_length("role").cast("string"), "role", "text"), 256)).alias("said"),
    )
    spoken = told.where("not gone").groupBy("conv_id", "said").agg(
        F.count("*").alias("copies"), F.bool_or(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("first")
    )
    first = F.when(F.col("unnumbered"), None).otherwise(F.col("first"))
    repeated = written(spoken.where("copies > 1").select("conv_id", "said", "copies", first.alias("first")), "said-again")
    both = told.join(repeated, _null_safe(told, repeated, "conv_id") & (told["said"] == repeated["said"]), "left")
    later = repeated["copies"].isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    return both.select(*(told[name] for name in told.columns), later.alias("later"))


def _ordered(rows: DataFrame, *before: str) -> DataFrame:
    """Rows of a conversation in one partition, in order."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *before, F.col("turn").asc_nulls_first(), "role", "text")


_SIGNED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"


def _signed(batches, schema: pa.Schema):
    made, held = [], None
    report, symbols = {}, []

    def close() -> None:
        if held is None:
            return
        low, high = report.pop("low"), report.pop("high")
        report["gaps"] = 0 if low is None else high - low + 1 - report.pop("numbers")
        made.append({name: report.get(name) for name in schema.names} | {"signature": "".join(symbols)})

    before = initial_before = None
    for batch in batches:
        for conv_id, turn, initial, fault, said, later, gone in zip(*(column.to_pylist() for column in batch.columns)):
            if held != (conv_id,):
                close()
                held, symbols, before, initial_before = (conv_id,), [], None, None
                report = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "numbers"), 0) | {"conv_id": conv_id, "low": None, "high": None}
            if gone:
                continue
            if turn is not None and turn != report["high"]:
                report["low"] = turn if report["low"] is None else report["low"]
                report["high"] = turn
                report["numbers"] += 1
            if fault != "blank" and (later or before == (turn, said)):
                fault = "duplicate"
            if fault:
                report[fault] += 1
            if initial_before is not None and initial_before + initial not in LEGAL:
                report["illegal"] += 1
            symbols.append("x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
            before, initial_before = (turn, said), initial
        if len(made) >= 1024:
            yield pa.RecordBatch.from_pylist(made, schema)
            made.clear()
    close()
    if made:
        yield pa.RecordBatch.from_pylist(made, schema)


def signed(rows: DataFrame) -> DataFrame:
    """One row per conversation of `rows_of`: gaps, numbers of faults, illegal neighbours, and its signature."""
    columns = _ordered(rows).select("conv_id", "turn", "initial", "fault", "said", "later", "gone")
    return arrow.mapped(columns, partial(_signed, schema=arrow.arrow_schema(_SIGNED)), _SIGNED)


class Node:
    """An ending of signatures: per grammar state its least cost to go, and the first letter of its best audit."""

    __slots__ = ("costs", "letters", "symbol")

    def __init__(self, symbol: str = "", rest: Node | None = None):
        self.symbol = symbol
        options: list[dict[str, int]] = []
        for state in range(4):
            found = {"": 0} if rest is None and state in ACCEPTED else {}
            if rest is not None:
                found[DELETE] = COST[DELETE] + rest.costs[state]
                if symbol != "x":
                    stays = CUT_OFF if symbol.isupper() else 0
                    found[REROLE] = COST[REROLE] + stays + rest.costs[NEXT[state]]
                    if (kept := AFTER[state].get(symbol.lower())) is not None:
                        found[KEEP] = COST[KEEP] + stays + rest.costs[kept]
            options.append(found)
        self.costs = [min(found.values(), default=1 << 62) for found in options]
        for _ in range(2):  # nobody inserts more than a user's and an assistant's turn at one place
            for state in range(4):
                self.costs[state] = min(self.costs[state], COST[INSERT] + self.costs[NEXT[state]])
        self.letters = []
        for state, found in enumerate(options):
            found[INSERT] = COST[INSERT] + self.costs[NEXT[state]]
            self.letters.append(min(letter for letter, cost in found.items() if cost == self.costs[state]))


class Endings:
    """The nodes of one signature after another, from the end, as far as they are shared."""

    def __init__(self):
        self.nodes = [Node()]
        self.ending = ""
        self.made = 0

    def turn_to(self, ending: str) -> None:
        """Go to a signature, given from its end; only nodes that the one before did not have are made."""
        common, limit = 0, min(len(ending), len(self.ending))
        while common < limit and ending[common] == self.ending[common]:
            common += 1
        del self.nodes[1 + common :]
        for symbol in ending[common:]:
            self.nodes.append(Node(symbol, self.nodes[-1]))
        self.made += len(ending) - common
        self.ending = ending

    def audit(self) -> tuple[int, str]:
        """Cost and letters of the best repair of the current signature."""
        at, state, letters = len(self.nodes) - 1, START, []
        while letter := self.nodes[at].letters[state]:
            letters.append(letter)
            if letter in (INSERT, REROLE):
                state = NEXT[state]
            elif letter == KEEP:
                state = AFTER[state][self.nodes[at].symbol.lower()]
            at -= letter != INSERT
        return self.nodes[-1].costs[START], "".join(letters)


_AUDITED = "signature string, cost long, audit string, nodes long"


def _audited(batches, schema: pa.Schema):
    endings = Endings()
    for batch in batches:
        rows = []
        for ending in batch.column("ending").to_pylist():
            before = endings.made
            endings.turn_to(ending)
            rows.append((ending[::-1], *endings.audit(), endings.made - before))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*rows), schema)], schema=schema)


def audits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit, nodes) of every distinct signature; `nodes` is how many nodes it added."""
    endings = signatures.select(F.reverse("signature").alias("ending")).distinct()
    dealt = endings.repartitionByRange("ending").sortWithinPartitions("ending")
    return arrow.mapped(dealt, partial(_audited, schema=arrow.arrow_schema(_AUDITED)), _AUDITED)


def reports(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps, numbers of faults, illegal neighbours, signature, cost and audit; a written table."""
    told = written(signed(rows), "signed")
    best = written(audits(told).select("signature", "cost", "audit"), "audits")
    return written(told.join(best, "signature"), "repair-reports")


_REPAIRED = "conv_id long, place long, edit string, role string, text string"


def _repaired(batches, schema: pa.Schema):
    held, letters, state, place, made = None, iter(()), START, 0, []

    def said(edit: str, role: str, text: str) -> None:
        nonlocal place
        made.append((held[0], place, edit, role, text))
        place += 1

    def until_row() -> str:
        """The letter of the next row, after the insertions before it; none at the end."""
        nonlocal state
        for letter in letters:
            if letter != INSERT:
                return letter
            state = NEXT[state]
            said(INSERT, NAMES[state], "")
        return ""

    for batch in batches:
        for conv_id, audit, role, text in zip(*(column.to_pylist() for column in batch.columns)):
            if audit is not None:
                until_row()
                held, letters, state, place = (conv_id,), iter(audit), START, 0
                continue
            letter = until_row()
            if letter == REROLE:
                state = NEXT[state]
                said(REROLE, NAMES[state], text)
            elif letter == KEEP:
                state = AFTER[state][role[0]]
                said(KEEP, role, text)
            if len(made) >= arrow.SLICE_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*made), schema)], schema=schema)
                made = []
    until_row()
    if made:
        yield pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*made), schema)], schema=schema)


def repaired_turns(rows: DataFrame, reported: DataFrame) -> DataFrame:
    """The turns after repair: conversation, place from 0, edit, role, text; a conversation's turns are neighbours, in order."""
    nothing = F.lit(None).cast("string")
    heads = reported.select("conv_id", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), nothing.alias("role"), nothing.alias("text"), "audit", F.lit(0).alias("kind"))
    turns = rows.where("not gone").select("conv_id", "turn", "role", "text", nothing.alias("audit"), F.lit(1).alias("kind"))
    columns = _ordered(heads.unionByName(turns), "kind").select("conv_id", "audit", "role", "text")
    return arrow.mapped(columns, partial(_repaired, schema=arrow.arrow_schema(_REPAIRED)), _REPAIRED)


_DIGESTS = "conv_id long, repaired_sha256 string"


def _digested(batches, schema: pa.Schema):
    held, digest, made = None, None, []
    for batch in batches:
        for conv_id, role, text in zip(*(column.to_pylist() for column in batch.columns)):
            if held == (conv_id,):
                digest.update(b"\n")
            else:
                if held is not None:
                    made.append({"conv_id": held[0], "repaired_sha256": digest.hexdigest()})
                held, digest = (conv_id,), hashlib.sha256()
            digest.update(f"{role}:{text}".encode())
        if len(made) >= 1024:
            yield pa.RecordBatch.from_pylist(made, schema)
            made = []
    if held is not None:
        made.append({"conv_id": held[0], "repaired_sha256": digest.hexdigest()})
        yield pa.RecordBatch.from_pylist(made, schema)


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 over `role:text` of a conversation's turns, joined by line ends; `repaired` as `repaired_turns` returns it."""
    return arrow.mapped(repaired.select("conv_id", "role", "text"), partial(_digested, schema=arrow.arrow_schema(_DIGESTS)), _DIGESTS)
