"""Operator 11: repair of conversation structure by the cheapest edits.

``repair`` takes conversations (conv_id, turn, role, text) and returns their edits: Keep, Rerole,
Delete and Insert rows in order, so that the roles read ``(s?(ua)+)?`` at the least cost; of equal
costs the audit (the edits' initials) that is ASCII-least wins.  The search is a bidirectional
Dijkstra over the edit lattice (``edit_lattice``): forward and reverse heaps meet, all crossings of the
best cost are finished, then the least concatenated audit is picked.

How a conversation is dealt: equal rows are counted first, so copies travel as one row with their
number.  Rows without their texts are ordered by range over (conv_id, turn, ...), so one long
conversation spreads over many tasks; each task makes pieces of at most ``PIECE`` rows, searches full
pieces between all pairs of states, and a conversation's pieces are joined in order.  Only the
conversations' audits meet the texts again, which pass in order, one batch at a time.

Defined results: rows go by turn, nulls first; rows of one turn by role, then by a digest of role and
text.  A null role or text is one space; a null conv_id is a conversation like others; repeated rows
are duplicates; columns of other names are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.session import materialized

from . import edit_lattice as lattice
from .common import table

# rows of a conversation that are searched in one go
PIECE = 1024
# whole short conversations whose repair is remembered per task
REMEMBERED, REMEMBERED_ROWS = 100_000, 40

_SPACES = " \t\n\x0b\x0c\r"
SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def damage(rows: DataFrame) -> DataFrame:
    """Damaged ``conversations`` (conv_id, turn, role, text, copies) by crc32(conv_id:turn) % 20: 0
    drops the row (copies 0), 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 sets role user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("kind"))
    kind = F.col("kind")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    ).withColumn("text", F.coalesce("text", F.lit(" ")))


def _keyed(rows: DataFrame) -> DataFrame:
    """Nulls as one space, and ``k``: a digest of conversation, role and text."""
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], copies.cast("long").alias("copies"))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    k = F.sha2(F.concat_ws(":", F.length(conv), conv, F.length("role"), "role", "text").cast("binary"), 256)
    return rows.withColumn("k", F.unhex(k))


def _slim(keyed: DataFrame) -> DataFrame:
    """(conv_id, turn, role, k, n, symbol, blank) of distinct rows: n copies; symbol as in the lattice
    where the row stays; first is whether no earlier turn has the same role and text."""
    trimmed = F.rtrim("text", F.lit(_SPACES))
    rows = keyed.select("conv_id", "turn", "role", "k", "copies", (trimmed == "").alias("blank"),
                        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    rows = materialized(rows.groupBy("conv_id", "turn", "role", "k").agg(F.sum("copies").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut")), "rows")
    # few groups have rows in more than one turn; rows without copies (dropped ones) are no earlier row
    earliest = (rows.where("n > 0").groupBy("k").agg(F.count("*").alias("turns"), F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("earliest"))
                .where("turns > 1").select("k", "earliest"))
    first = F.col("earliest").isNull() | (F.struct(F.col("turn").isNotNull().alias("has"), "turn").eqNullSafe(F.col("earliest")))
    return rows.join(earliest, "k", "left").select("conv_id", "turn", "role", "k", "n", "blank", "cut", first.alias("first"))


@dataclass
class Piece:
    """Consecutive rows of one conversation: counts, edges towards its neighbours, symbols."""

    conv: int | None = None
    order: tuple = ()
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: str = ""
    last: str = ""
    symbols: list[str] = field(default_factory=list)
    rows: int = 0

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last", "rows")

    def pair(self, before: str, role: str, times: int = 1) -> None:
        self.illegal += times * (before + role not in ("su", "ua", "au"))

    def row(self, turn: int | None, initial: str, symbol: str, times: int) -> None:
        """``times`` equal rows at the end."""
        if self.rows:
            self.pair(self.last, initial)
        else:
            self.first = initial
        self.pair(initial, initial, times - 1)
        self.last = initial
        self.rows += times
        self.symbols.append(symbol * times)
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low

    def join(self, other: Piece) -> None:
        """``other`` follows."""
        for f in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, f, getattr(self, f) + getattr(other, f))
        if other.rows:
            if self.rows:
                self.pair(self.last, other.first)
            else:
                self.first = other.first
            self.last = other.last
            self.rows += other.rows
        if other.low is not None:
            self.turns += other.turns - (self.high == other.low)
            self.low, self.high = other.low if self.low is None else self.low, other.high

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


_PIECE_DDL = ("has boolean, turn long, role string, k binary, part long, blank long, duplicate long, truncated long, illegal long, "
              "turns long, low long, high long, first string, last string, rows long, symbols string, best string")


def _packed_table(symbols: str) -> str:
    return ";".join(f"{s}{t}{cost}:{audit}" for (s, t), (cost, audit) in sorted(lattice.table(symbols).items()))


def _unpacked_table(text: str) -> lattice.Table:
    out = {}
    for cell in text.split(";"):
        head, audit = cell.split(":")
        out[int(head[0]), int(head[1])] = (int(head[2:]), audit)
    return out


def _pieces(slim: DataFrame, size: int) -> DataFrame:
    """Pieces of at most ``size`` rows; a full one comes with its table (``best``)."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "k")]
    ordered = slim.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def close() -> None:
            full = now.rows >= size
            symbols = "".join(now.symbols)
            out.append((now.conv, *now.order, *(getattr(now, f) for f in Piece.FIELDS), symbols, _packed_table(symbols) if full else None))

        def flush() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out.clear()
            return got

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "k", "n", "blank", "cut", "first"))
            for conv, turn, role, k, n, blank, cut_off, first in zip(*columns, strict=True):
                initial, part = role[:1], 0
                stays = 0 if blank or not first else min(n, 1)
                symbol = initial if initial and initial in "sua" else "x"
                for how, times in ((symbol.upper() if cut_off else symbol, stays), ("-", n - stays)):
                    while times or (n == 0 and how != "-"):
                        if now is None or now.conv != conv or now.rows >= size:
                            if now is not None:
                                close()
                                if len(out) >= 2000 or out[-1][-1] is not None:
                                    yield flush()
                            now = Piece(conv, (turn is not None, turn, role, k, part))
                        if not n:
                            break
                        some = min(times, size - now.rows)
                        now.row(turn, initial, how, some)
                        if how != "-":
                            now.truncated += some * cut_off
                        elif blank:
                            now.blank += some
                        else:
                            now.duplicate += some
                        times -= some
                        part += 1
        if now is not None:
            close()
        if out:
            yield flush()

    schema = slim.select("conv_id").schema
    names, types = _arrow_fields(schema, _PIECE_DDL)
    for f in _struct(_PIECE_DDL).fields:
        schema = schema.add(f)
    return ordered.mapInArrow(cut, schema)


def _struct(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def _arrow_fields(schema, ddl: str) -> tuple[list[str], list[pa.DataType]]:
    from pyspark.sql.pandas.types import to_arrow_type

    fields = [*schema.fields, *_struct(ddl).fields]
    return [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]


def _summaries(pieces: DataFrame, size: int) -> DataFrame:
    """(conv_id, counts, cost, audit) of each conversation from its pieces in order."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "has", "turn", "role", "k", "part")]
    ordered = pieces.repartition("conv_id").sortWithinPartitions(*order)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, str]] = {}

        def solved(symbols: str) -> tuple[int, str]:
            got = known.get(symbols)
            if got is None:
                got = lattice.cheapest(symbols)
                if len(symbols) <= REMEMBERED_ROWS:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[symbols] = got
            return got

        now, held, path, out = None, "", None, []

        def join(piece: Piece, symbols: str, best: str | None) -> None:
            nonlocal held, path
            now.join(piece)
            # short runs wait for more; longer ones go on the path
            if best is None and len(held) + len(symbols) <= size:
                held += symbols
                return
            path = path or lattice.Path()
            if held:
                path.add(lattice.table(held))
            held = ""
            if best is None:
                held = symbols
            else:
                path.add(_unpacked_table(best))

        def close() -> None:
            if path is None:
                cost, audit = solved(held)
            else:
                if held:
                    path.add(lattice.table(held))
                cost, audit = path.result()
            out.append((now.conv, now.gaps(), now.blank, now.duplicate, now.truncated, now.illegal, cost, audit))

        def flush() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out.clear()
            return got

        for batch in batches:
            for r in batch.to_pylist():
                if now is None or now.conv != r["conv_id"]:
                    if now is not None:
                        close()
                        if len(out) >= 2000:
                            yield flush()
                    now, held, path = Piece(r["conv_id"]), "", None
                join(Piece(**{f: r[f] for f in Piece.FIELDS}), r["symbols"], r["best"])
        if now is not None:
            close()
        if out:
            yield flush()

    schema = pieces.select("conv_id").schema
    names, types = _arrow_fields(schema, SUMMARY)
    for f in _struct(SUMMARY).fields:
        schema = schema.add(f)
    return ordered.mapInArrow(fold, schema)


def summaries(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row a conversation: gaps, blank, duplicate, truncated, illegal, cost, audit."""
    return _summaries(_pieces(_slim(_keyed(rows)), piece), piece)


EDITS = f"step long, edit string, role string, text string, summary struct<{SUMMARY.replace(' long', ': long').replace(' string', ': string')}>"


def repair(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """The edits of each conversation in order: (conv_id, step, edit, role, text, summary).  Step 0
    has the conversation's summary and no edit; a deleted row's role is null.  A partition holds whole
    conversations, each in order."""
    keyed = _keyed(rows)
    found = materialized(_summaries(_pieces(_slim(keyed), piece), piece), "audits")
    head = found.select("conv_id", F.lit(0).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("k", "binary"), ("text", "string"), ("copies", "long"))],
                        F.struct(*[c for c in found.columns if c != "conv_id"]).alias("summary"))
    body = keyed.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", "k", "text", "copies",
                                            F.lit(None).cast(head.schema["summary"].dataType).alias("summary"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "turn", "role", "k")]
    ordered = head.unionByName(body).repartition("conv_id").sortWithinPartitions(*order)

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, step, due, out, held = "", 0, 0, "user", [], 0

        def put(conv, letter, role, text, summary=None) -> None:
            nonlocal step, held
            out.append((conv, step, letter, role, text, summary))
            step += 1
            held += 40 + len(text or "")

        def act(conv, role, text) -> None:
            """The inserts that are due, then the edit that takes this row (none at the end)."""
            nonlocal at, due
            while at < len(audit) and audit[at] == lattice.INSERT:
                put(conv, lattice.INSERT, due, "")
                due = "assistant" if due == "user" else "user"
                at += 1
            if role is None:
                return
            letter = audit[at]
            at += 1
            if letter == lattice.DELETE:
                put(conv, letter, None, text)
                return
            new = role if letter == lattice.KEEP else due
            put(conv, letter, new, text)
            if new[:1] != "s":
                due = "assistant" if new[:1] == "u" else "user"

        def flush() -> pa.RecordBatch:
            nonlocal held
            got = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out.clear()
            held = 0
            return got

        conv = None
        for batch in batches:
            for r in batch.select(["conv_id", "kind", "role", "text", "copies", "summary"]).to_pylist():
                if r["kind"] == 0:
                    if step:
                        act(conv, None, None)
                    conv, audit, at, step, due = r["conv_id"], r["summary"]["audit"], 0, 0, "user"
                    put(conv, None, None, None, r["summary"])
                else:
                    for _ in range(r["copies"]):
                        act(conv, r["role"], r["text"])
                if held > 1 << 20:
                    yield flush()
        if step:
            act(conv, None, None)
        if out:
            yield flush()

    schema = rows.select("conv_id").schema
    names, types = _arrow_fields(schema, EDITS)
    for f in _struct(EDITS).fields:
        schema = schema.add(f)
    return ordered.mapInArrow(edits, schema)


def digests(edits: DataFrame) -> DataFrame:
    """One row a conversation from ``repair``'s edits as they come (no shuffle in between): its summary
    and the SHA-256 of its repaired ``role:text``, joined by line feeds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, empty, out = None, None, True, []

        def flush() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out.clear()
            return got

        for batch in batches:
            for r in batch.to_pylist():
                if r["summary"] is not None:
                    if now is not None:
                        out.append((*now, sha.hexdigest()))
                        if len(out) >= 2000:
                            yield flush()
                    now, sha, empty = (r["conv_id"], *r["summary"].values()), hashlib.sha256(), True
                elif r["role"] is not None:
                    sha.update((("" if empty else "\n") + r["role"] + ":").encode())
                    sha.update(r["text"].encode())
                    empty = False
        if now is not None:
            out.append((*now, sha.hexdigest()))
        if out:
            yield flush()

    ddl = SUMMARY + ", repaired_sha256 string"
    schema = edits.select("conv_id").schema
    names, types = _arrow_fields(schema, ddl)
    for f in _struct(ddl).fields:
        schema = schema.add(f)
    return edits.mapInArrow(work, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(repair(damage(table(spark, sf_dir, "conversations"))))
