"""Chat formatting by event-sourced reconstruction.

A log holds events ``(conv_id, position, message, seq, kind, role, text)`` of messages:

* ``open``: the message begins, said by ``role``;
* ``delta``: ``text`` is appended (a streamed piece);
* ``edit``: the text so far is replaced by ``text``;
* ``regenerate``: the text so far is thrown away, deltas follow;
* ``remove``: the message is taken back.

1. *Fold*: the log is dealt by conversation and message and sorted by sequence; each message's
   events are folded into its final text and rendered at once. One message at a time is in
   memory, so a conversation of any length is spread over the tasks.
2. *Render*: a message is one turn of the template, its text with all control strings escaped.
3. *Place*: turns are dealt by conversation in order (position, role, digest of the text, message);
   one pass gives each turn its offset and loss span in the conversation's text, which is the
   concatenation of its turns. Only offsets are kept between turns.

Template: ``<s>``, then per turn ``[INST] .. [/INST]`` (user), ``[OUT] .. </s>`` (assistant),
``[SYS] .. [/SYS]`` (system), ``[ROLE=name] .. [/ROLE]`` (any other role, its name percent-encoded).
The loss mask covers the escaped texts of the assistant. A control string inside a text, with
any number of backslashes after its first character, gets one more; reading takes one away,
so escaping is reversible and an escaped text never holds a control string.

Defined results: a NULL text or role counts as empty; an event delivered again (same
message and sequence number) counts once, events of unknown kinds or without a sequence number not at all; a
message without ``open`` has the empty role; NULL conversation ids are one conversation; NULL
positions come last; messages of equal position keep the order above; an empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks of the template, by role.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", " </s>"), "system": ("[SYS] ", " [/SYS]")}
OTHER = ("[ROLE=", "] ", " [/ROLE]")
BEGIN = "<s>"
CONTROL = r"([<\[])(\\*)(?=/?s>|/?INST\]|OUT\]|/?SYS\]|ROLE=|/ROLE\])"
LOSS_ROLE = "assistant"
KINDS = ["open", "delta", "edit", "regenerate", "remove"]

LOG = "conv_id long, position long, message long, seq long, kind string, role string, text string"
TURNS = ("conv_id long, position long, role string, text_md5 string, message long, "
         "segment string, body_start long, body_length long")
PLACED = "conv_id long, place long, segment string, start long, loss_start long, loss_length long"
FLUSH_BYTES = 4 << 20


def escape(text: str) -> str:
    import re
    return re.sub(CONTROL, r"\1\2" + "\\\\", text)


def unescape(text: str) -> str:
    import re
    return re.sub(CONTROL.replace(r"(\\*)", r"(\\*)\\"), r"\1\2", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """``(segment, start, length)``: the turn, and where its escaped text lies in it."""
    from urllib.parse import quote
    body = escape(text)
    before, after = MARKS.get(role) or (OTHER[0] + quote(role, safe="") + OTHER[1], OTHER[2])
    return before + body + after, len(before), len(body)


def read_turn(segment: str) -> tuple[str, str]:
    """``(role, text)`` of a rendered turn (the first one of a conversation begins with ``BEGIN``)."""
    import re
    from urllib.parse import unquote
    turn = segment.removeprefix(BEGIN)
    for role, (before, after) in MARKS.items():
        if turn.startswith(before) and turn.endswith(after):
            return role, _body(turn, len(before), len(after))
    named = re.match(r"\[ROLE=([^\]]*)\] ", turn)
    if not named or not turn.endswith(OTHER[2]):
        raise ValueError(f"not a turn of the template: {segment[:80]!r}")
    return unquote(named.group(1)), _body(turn, named.end(), len(OTHER[2]))


def _body(turn: str, before: int, after: int) -> str:
    import re
    body = turn[before:len(turn) - after]
    if any(not m.group(2) for m in re.finditer(CONTROL, body)):
        raise ValueError(f"a control string inside a turn: {turn[:80]!r}")
    return unescape(body)


def _rows_of(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


class _Out:
    """Rows gathered to record batches of bounded size."""

    def __init__(self, schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row, size):
        self.rows.append(row)
        self.size += size + 64
        return self.size >= FLUSH_BYTES

    def batch(self):
        import pyarrow as pa
        fields = [f.strip().split(" ") for f in self.schema.split(",")]
        types = {"long": pa.int64(), "string": pa.string()}
        columns = zip(*self.rows) if self.rows else [[] for _ in fields]
        out = pa.RecordBatch.from_arrays([pa.array(list(c), types[t]) for c, (_, t) in zip(columns, fields)],
                                         names=[n for n, _ in fields])
        self.rows, self.size = [], 0
        return out


def fold(log: DataFrame) -> DataFrame:
    """``TURNS``: every message's final text as a rendered turn, not in order."""
    def run(batches):
        from hashlib import md5
        out = _Out(TURNS)
        key, seen, role, parts, gone, position = None, None, "", [], False, None

        def close():
            if key is None or gone:
                return False
            text = "".join(parts)
            segment, start, length = render(role, text)
            return out.add((key[0], position, role, md5(text.encode("utf-8", "replace")).hexdigest(), key[1], segment, start, length),
                           len(segment))

        for conv, at, message, seq, kind, who, text in _rows_of(batches):
            if (conv, message) != key:
                if close():
                    yield out.batch()
                key, seen, role, parts, gone, position = (conv, message), None, "", [], False, at
            if seq == seen:
                continue
            seen = seq
            if kind == "open":
                role = who or ""
            elif kind == "delta":
                parts.append(text or "")
            elif kind == "edit":
                parts = [text or ""]
            elif kind == "regenerate":
                parts = []
            elif kind == "remove":
                gone = True
        close()
        yield out.batch()

    log = log.select("conv_id", "position", "message", "seq", "kind", "role", "text").filter(
        F.col("seq").isNotNull() & F.col("kind").isin(KINDS))
    ordered = log.repartition("conv_id", "message").sortWithinPartitions(
        "conv_id", "message", "seq", "kind", "role", "text")
    return ordered.mapInArrow(run, TURNS)


def format_chats(log: DataFrame) -> DataFrame:
    """``PLACED``: the turns of every conversation in order; their segments, concatenated, are its formatted text.

    ``start`` and ``loss_start`` count code points of that text; turns without loss have a
    ``loss_length`` of 0. The rows of a conversation lie in one partition, in order.
    """
    def run(batches):
        out = _Out(PLACED)
        current, place, start = (), 0, 0
        for conv, _, role, _, _, segment, body, length in _rows_of(batches):
            if (conv,) != current:
                current, place, start = (conv,), 0, 0
                segment, body = BEGIN + segment, body + len(BEGIN)
            full = out.add((conv, place, segment, start, start + body, length if role == LOSS_ROLE else 0), len(segment))
            place, start = place + 1, start + len(segment)
            if full:
                yield out.batch()
        yield out.batch()

    turns = fold(log).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id"), F.col("position").asc_nulls_last(), F.col("role"), F.col("text_md5"), F.col("message"))
    return turns.mapInArrow(run, PLACED)


def read_back(placed: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text alone: turns and text under the loss mask, as running digests.

    ``placed`` must come in the order in which ``format_chats`` returns it.
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")

    def run(batches):
        from hashlib import sha256
        out = _Out(schema)
        current = ()
        for conv, _, segment, start, loss, length in _rows_of(batches):
            if (conv,) != current:
                if current and out.add((*current, n, turns.hexdigest(), chars, masked.hexdigest(), size), 200):
                    yield out.batch()
                current, n, turns, chars, masked, size = (conv,), 0, sha256(), 0, sha256(), 0
            role, text = read_turn(segment)
            n, size = n + 1, size + len(segment)
            turns.update(f"{role}\n{text}\n".encode())
            if length:
                under = unescape(segment[loss - start:loss - start + length])
                chars += len(under)
                masked.update(under.encode())
        if current:
            out.add((*current, n, turns.hexdigest(), chars, masked.hexdigest(), size), 200)
        yield out.batch()

    return placed.mapInArrow(run, schema)


def log_of(rows: DataFrame, draft: Column, delta_chars: int = 512) -> DataFrame:
    """A log that leads to the final messages ``(conv_id, turn, role, text)``: what a chat service would have written.

    Texts arrive in deltas of ``delta_chars`` code points. Where ``draft`` holds, a first attempt (the text's beginning)
    came before: an assistant's is regenerated, any other's is edited to the whole text.
    """
    text = F.coalesce("text", F.lit(""))
    pieces = F.regexp_extract_all("t", F.lit("(?s).{1,%d}" % delta_chars), F.lit(0))
    event = lambda seq, kind, t=F.lit(None): F.struct(
        seq.cast("long").alias("seq"), F.lit(kind).alias("kind"), t.cast("string").alias("text"))
    deltas = F.transform("p", lambda x, i: event(i + 3, "delta", x))
    first = F.substring("t", 1, 40)
    drafted = F.array(event(F.lit(0), "open"), event(F.lit(1), "delta", first))
    steps = F.when(F.col("d") & (F.col("role") == LOSS_ROLE),
                   F.concat(drafted, F.array(event(F.lit(2), "regenerate")), deltas)).when(
        F.col("d"), F.concat(drafted, F.array(event(F.lit(2), "edit", F.col("t"))))).otherwise(
        F.concat(F.array(event(F.lit(0), "open")), deltas))
    rows = rows.select("conv_id", F.col("turn").alias("position"), "role", text.alias("t"),
                       F.coalesce(draft, F.lit(False)).alias("d"),
                       F.monotonically_increasing_id().alias("message"))
    rows = rows.withColumn("p", pieces)
    return rows.select("conv_id", "position", "message", "role", F.explode(steps).alias("e")).select(
        "conv_id", "position", "message", "e.seq", "e.kind", "role", "e.text")
