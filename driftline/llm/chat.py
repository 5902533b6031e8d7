"""Chat formatting: schema fingerprints choose how records become canonical turns.

Records come in many layouts: rows by turn, prompt and completion, instruction with
input, lists of messages.  A record's nested field paths (``messages[].role``), as
far as any layout knows them, are sorted and hashed.  The hash is the key of a table
of declarative mappings; a mapping says where roles and texts are, and nothing about
a record's data is guessed.  For a table the paths come from its schema, once; for
JSON texts they come from each record.

A canonical turn is formatted as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control
strings inside texts are escaped: ``<|`` with any number of ``!`` in between gets one
more, so no text holds ``<|``, and reading back takes one away.  The loss mask covers
the text of each assistant turn, without the marks around it.

Conversations are read back in the order of their turns, as a stream with one running
digest each: rows are dealt out by conversation and sorted (on disk if need be), and a
task holds one batch and not a conversation.

Inputs and edge cases: a null text or role is empty; turns without a number come first,
and equal numbers are ordered by role and text, repeats kept; rows without a conversation
id form one conversation; an empty table gives an empty result; unknown columns do not
matter; a table or record in no known layout raises (table) or gives no turns (record).
A message's content may be a list of parts, joined by blank lines (a part without text as
its JSON).  Records of no exact layout are listed with the reason by ``rejected_from_json``
and ``rejected_from_table``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_hexdigest

OPEN, CLOSE, BREAK = "<|im_start|>", "<|im_end|>", "<|br|>"
LEARNT_ROLE = "assistant"


@dataclass(frozen=True)
class Layout:
    """How one layout becomes turns.

    ``parts``: (role, fields joined by blank lines) for each turn of a flat record;
    ``items``, ``role``, ``text``: a list of messages and the names in a message;
    ``system``: the field with the first turn, beside a list of messages;
    ``order``: the field with the turn's number if each row is a turn itself."""

    name: str
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    order: str = ""
    system: str = ""
    roles: dict[str, str] = field(default_factory=dict)

    def paths(self) -> frozenset[str]:
        if self.items:
            return frozenset({f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"} | ({self.system} if self.system else set()))
        if self.order:
            return frozenset({self.order, self.role, self.text})
        return frozenset(f for _, fields in self.parts for f in fields)


# Field names of common layouts.
LAYOUTS = (
    Layout("turn rows", role="role", text="text", order="turn"),
    Layout("prompt and completion", parts=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt and response", parts=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("system, prompt and response",
           parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question and answer", parts=(("user", ("question",)), ("assistant", ("answer",)))),
    Layout("instruction", parts=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction with input", parts=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("messages", items="messages", role="role", text="content"),
    Layout("shared conversations", items="conversations", role="from", text="value",
           roles={"human": "user", "gpt": "assistant"}),
)


def _with_system(layout: Layout) -> Layout:
    name = f"system and {layout.name}"
    if layout.items:
        return replace(layout, name=name, system="system")
    return replace(layout, name=name, parts=(("system", ("system",)), *layout.parts))


_NAMED = {layout.paths() for layout in LAYOUTS}
LAYOUTS += tuple(x for x in map(_with_system, (x for x in LAYOUTS if x.items or x.parts and x.parts[0][0] != "system"))
                 if x.paths() not in _NAMED)


def known(paths: Iterable[str]) -> set[str]:
    """The paths that any layout knows; paths inside a content's parts are those of the content."""
    paths = {next((c for c in _CONTENTS if p.startswith(f"{c}[]")), p) for p in paths}
    return paths & _KNOWN


def fingerprint(paths: Iterable[str]) -> str:
    """Hash of the sorted paths that any layout knows."""
    return xxh64_hexdigest("\n".join(sorted(known(paths))))


def layout_of(paths: Iterable[str]) -> Layout | None:
    """The layout of the paths' fingerprint; if fields of several layouts are there,
    the largest layout that is there in full (the first listed among equals)."""
    paths = known(paths)
    exact = MAPPINGS.get(fingerprint(paths))
    if exact:
        return exact
    return max((x for x in LAYOUTS if x.paths() <= paths), key=lambda x: len(x.paths()), default=None)


_CONTENTS = tuple(sorted({f"{layout.items}[].{layout.text}" for layout in LAYOUTS if layout.items}))
_KNOWN = frozenset(p for layout in LAYOUTS for p in layout.paths())
MAPPINGS = {fingerprint(layout.paths()): layout for layout in LAYOUTS}


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a Spark type; a list adds ``[]``."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


_PATH_SIGNS = str.maketrans({c: f"\\{c}" for c in "\\.[]"})
_LONE = re.compile("[\ud800-\udfff]")


def value_paths(value: object, at: str = "") -> set[str]:
    """Nested field paths of a JSON value; signs of a path inside a key are escaped."""
    if isinstance(value, dict):
        keys = ((k.translate(_PATH_SIGNS), v) for k, v in value.items())
        return {p for k, v in keys for p in value_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in value_paths(v, f"{at}[]")} or {f"{at}[]"}
    return {at}


def _said(value: object) -> str:
    """A value's text; half a surrogate pair is no character and becomes U+FFFD."""
    text = "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return _LONE.sub("\ufffd", text)


def _content(value: object) -> str:
    """A message's text: as it is, or its parts joined by blank lines."""
    if not isinstance(value, list):
        return _said(value)
    return "\n\n".join(_said(p["text"] if isinstance(p, dict) and p.get("text") is not None else p) for p in value)


def record_turns(record: object) -> list[tuple[str, str]]:
    """(role, text) of a JSON record, by the mapping of its fingerprint."""
    layout = layout_of(value_paths(record))
    if layout is None or not isinstance(record, dict):
        return []
    if layout.items:
        found = [(_said(m.get(layout.role)), _content(m.get(layout.text))) if isinstance(m, dict) else ("", _said(m))
                 for m in record[layout.items]]
        first = [("system", _said(record[layout.system]))] if layout.system else []
        return first + [(layout.roles.get(role, role), text) for role, text in found]
    if layout.order:
        return [(_said(record[layout.role]), _said(record[layout.text]))]
    return [(role, "\n\n".join(_said(record[f]) for f in fields if record[f])) for role, fields in layout.parts]


def turns_from_json(records: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conv_id, turn, role, text) of JSON texts in any mix of layouts.

    A record that is a turn itself brings its own number (null if that is no number)."""
    @F.pandas_udf("array<struct<turn:long,role:string,text:string>>")
    def run(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[dict[str, object]]:
            try:
                record = json.loads(text or "null")
                turns = [{"turn": k, "role": role, "text": said} for k, (role, said) in enumerate(record_turns(record))]
                layout = layout_of(value_paths(record))
            except (ValueError, RecursionError):
                return []
            if turns and layout.order:
                turns[0]["turn"] = _number(record[layout.order])
            return turns
        return texts.map(one)
    return records.select(F.col(id_col).alias("conv_id"), F.inline(run(F.col(json_col))))


def _number(value: object) -> int | None:
    try:
        number = int(value)
    except (TypeError, ValueError, OverflowError):
        return None
    return number if -2**63 <= number < 2**63 else None


def rejection(text: str | None) -> str | None:
    """Why a JSON text is no record of an exact layout, or null."""
    try:
        record = json.loads(text or "null")
        paths, turns = value_paths(record), record_turns(record)
    except ValueError:
        return "not JSON"
    except RecursionError:
        return "nested too deeply"
    layout = layout_of(paths)
    if layout is None or not isinstance(record, dict):
        return "no layout"
    left = sorted(known(paths) - layout.paths())
    if left:
        return f"fields left out: {', '.join(left)}"
    broken = _LONE.search(json.dumps(record, ensure_ascii=False)) and any("\ufffd" in part for turn in turns for part in turn)
    return "half surrogate pairs replaced" if broken else None


def rejected_from_json(records: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conv_id, record, reason) of JSON texts that are in no exact layout: they give no
    turns, or turns without the fields that the reason names."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(rejection)
    found = records.select(F.col(id_col).alias("conv_id"), F.col(json_col).alias("record"), run(F.col(json_col)).alias("reason"))
    return found.where("reason IS NOT NULL")


def rejected_from_table(records: DataFrame, id_col: str) -> DataFrame:
    """(conv_id, record, reason) of rows with a known field that the table's layout leaves out."""
    paths = schema_paths(records.schema)
    layout = layout_of(paths)
    left = sorted(known(paths) - (layout.paths() if layout else set()))
    full = F.lit(layout is None)
    for name in sorted({p.split("[")[0].split(".")[0] for p in left}):
        full = full | F.col(name).isNotNull()
    reason = f"fields left out: {', '.join(left)}" if layout else "no layout"
    return records.where(full).select(F.col(id_col).alias("conv_id"), F.to_json(F.struct("*")).alias("record"),
                                      F.lit(reason).alias("reason"))


def turns_from_table(records: DataFrame, id_col: str) -> DataFrame:
    """(conv_id, turn, role, text) of a table, by the mapping of its schema's fingerprint."""
    layout = layout_of(schema_paths(records.schema))
    if layout is None:
        raise ValueError(f"no layout has the fields of {records.columns}")
    key = F.col(id_col).alias("conv_id")

    def said(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    def named(c: Column) -> Column:
        pairs = [F.lit(x) for pair in layout.roles.items() for x in pair]
        return F.coalesce(F.element_at(F.create_map(*pairs), said(c)), said(c)) if pairs else said(c)

    if layout.order:
        return records.select(key, F.col(layout.order).cast("long").alias("turn"),
                              named(F.col(layout.role)).alias("role"), said(F.col(layout.text)).alias("text"))
    if layout.items:
        kind = records.schema[layout.items].dataType.elementType[layout.text].dataType

        def content(c: Column) -> Column:
            if not isinstance(kind, T.ArrayType):
                return said(c)
            if not isinstance(kind.elementType, T.StructType):
                return F.array_join(F.transform(c, said), "\n\n")
            has_text = "text" in kind.elementType.names
            return F.array_join(F.transform(c, lambda p: said(F.coalesce(p["text"], F.to_json(p)) if has_text else F.to_json(p))), "\n\n")

        turns = F.transform(layout.items, lambda m: F.struct(
            named(m[layout.role]).alias("role"), F.coalesce(content(m[layout.text]), F.lit("")).alias("text")))
        if layout.system:
            first = F.array(F.struct(F.lit("system").alias("role"), said(F.col(layout.system)).alias("text")))
            turns = F.concat(first, F.coalesce(turns, F.slice(first, 1, 0)))
        rows = records.select(key, F.posexplode(turns).alias("turn", "m"))
        return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "m.role", "m.text")
    parts = [F.struct(F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"),
                      F.concat_ws("\n\n", *[F.when(F.col(f) != "", F.col(f)) for f in fields]).alias("text"))
             for k, (role, fields) in enumerate(layout.parts)]
    return records.select(key, F.inline(F.array(*parts)))


def formatted(turns: DataFrame) -> DataFrame:
    """Add ``segment`` (the formatted turn) and its loss span (``loss_from``, ``loss_to``).

    A conversation's formatted text is its segments in the order of the turns."""
    def escaped(c: Column) -> Column:
        return F.regexp_replace(c, r"<(!*)\|", "<!$1|")

    head = F.concat(F.lit(OPEN), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(BREAK)), F.lit("\n"))
    body = escaped(F.col("text"))
    learnt = F.col("role") == LEARNT_ROLE
    return (turns.withColumn("segment", F.concat(head, body, F.lit(CLOSE + "\n")))
            .withColumn("loss_from", F.when(learnt, F.length(head)))
            .withColumn("loss_to", F.when(learnt, F.length(head) + F.length(body))))


_TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE) + "\n", re.DOTALL)
_ESCAPE = re.compile(r"<!(!*)\|")


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"<\1|", text)


def parse(segment: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    found = _TURN.fullmatch(segment)
    if not found:
        raise ValueError("not a formatted turn")
    return unescape(found[1].replace(BREAK, "\n")), unescape(found[2])


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.turns, self.loss, self.size = conv_id, 0, 0, 0
        self.all, self.learnt = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, loss_from: object, loss_to: object) -> None:
        role, text = parse(segment)
        self.turns += 1
        self.size += len(segment)
        self.all.update(f"{role}\n{text}\n".encode())
        if not pd.isna(loss_from):
            said = unescape(segment[int(loss_from):int(loss_to)])
            self.loss += len(said)
            self.learnt.update(said.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.learnt.hexdigest(), self.size)


def read_back(formatted_turns: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text and its mask alone: number of turns,
    digest of the turns, characters and digest under the mask, formatted characters."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for batch in batches:
            done = []
            for key, segment, a, b in zip(batch["conv_id"], batch["segment"], batch["loss_from"], batch["loss_to"], strict=True):
                key = None if pd.isna(key) else int(key)
                if now is None or now.conv_id != key:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(key)
                now.add(segment, a, b)
            out = pd.DataFrame(done, columns=names)
            out["conv_id"] = out["conv_id"].astype("Int64")
            yield out
        if now is not None:
            out = pd.DataFrame([now.row()], columns=names)
            out["conv_id"] = out["conv_id"].astype("Int64")
            yield out

    return (formatted_turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "segment", "loss_from", "loss_to")
            .mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                              "loss_sha256 string, formatted_chars long"))
