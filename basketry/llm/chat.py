"""Chat formatting (operator 5): compiled templates over conversations.

The rows of a conversation go to one task, sorted by turn, and stream through
the compiled template; output pieces, loss mask and digests are produced turn
by turn, so memory does not grow with a conversation.  A conversation is
sequential by definition (its digest is over the whole string), so one
conversation is the unit of work; rows are otherwise spread by conversation.

Texts and unknown roles are escaped: every occurrence of a control string, and
an ending that could become one together with what follows, is replaced by the
escape sign and a letter; the escape sign itself is escaped too.  So the only
control strings in the output are the template's, and :class:`Reader` gets the
turns back exactly.

Defined results: null text and null role are empty; rows with equal
(conversation, turn) are ordered by role and text; repeated rows are repeated
turns; null turns come first; a null conv_id is a conversation of its own; an
empty table gives only what the caller adds.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import table
from basketry.llm.template import compile_template

#: The control strings of the format.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
ESCAPE = "␛"
#: The production template.
TEMPLATE = (
    "{% for m in messages %}{% if loop.first %}<s>{% endif %}"
    "{% if m.role == 'user' %}[INST]{{ m.text | escape }}[/INST]"
    "{% elif m.role == 'system' %}<<SYS>>{{ m.text | escape }}<</SYS>>"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ m.role | escape }}[/ROLE]{{ m.text | escape }}</s>"
    "{% endif %}{% endfor %}"
)
#: What can be replaced: escape sign, control strings, and endings that start one.
_PARTS = sorted({c[:k] for c in CONTROLS for k in range(1, len(c))})
_CODES = [ESCAPE, *CONTROLS, *_PARTS]
_LETTER = {s: chr(0x41 + k) for k, s in enumerate(_CODES)}
_BACK = {v: k for k, v in _LETTER.items()}
_any = lambda xs: "|".join(re.escape(x) for x in sorted(xs, key=len, reverse=True))
ESCAPED = f"{_any([ESCAPE, *CONTROLS])}|(?:{_any(_PARTS)})$(?![\\s\\S])"
_ESCAPED = re.compile(ESCAPED)
_SEQUENCE = re.compile(f"{ESCAPE}(.)", re.S)
_CONTROL = re.compile(_any(CONTROLS))


def escape(s: str) -> str:
    return _ESCAPED.sub(lambda m: ESCAPE + _LETTER[m[0]], s or "")


def unescape(s: str) -> str:
    return _SEQUENCE.sub(lambda m: _BACK[m[1]], s)


class Reader:
    """Gets the turns back from formatted text, fed piece by piece.

    Pieces may end anywhere except inside a control string, as the template's
    pieces do."""

    #: opening control -> (role, closing control)
    OPEN = {"[INST]": ("user", "[/INST]"), "<<SYS>>": ("system", "<</SYS>>")}

    def __init__(self):
        self.role, self.close, self.text, self.begun = None, None, [], False

    def feed(self, piece: str):
        at = 0
        for m in _CONTROL.finditer(piece):
            yield from self._text(piece[at:m.start()])
            yield from self._control(m[0])
            at = m.end()
        yield from self._text(piece[at:])

    def _text(self, s: str):
        if s:
            if self.close is None:
                self.role, self.close = "assistant", "</s>"
            self.text.append(s)
        return iter(())

    def _control(self, c: str):
        if c == "<s>":
            return
        if self.close is None and c in self.OPEN:
            self.role, self.close = self.OPEN[c]
        elif self.close is None and c == "[ROLE]":
            self.close = "[/ROLE]"
        elif self.close == "[/ROLE]" and c == "[/ROLE]":
            self.role, self.close, self.text = unescape("".join(self.text)), "</s>", []
        elif c == (self.close or "</s>"):  # an assistant's empty text is only its end
            yield (self.role if self.close else "assistant"), unescape("".join(self.text))
            self.role, self.close, self.text = None, None, []
        else:
            raise ValueError(f"unexpected control string {c!r}")


def _arranged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    src = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col(text), F.lit("")).alias("text"))
    return src.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")


def _conversations(batches):
    """Consecutive rows of one conversation, as (id, iterator of turns)."""
    def rows():
        for b in batches:
            yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)

    it = rows()
    head = next(it, None)

    while head is not None:
        key = head[0]

        def turns():
            nonlocal head
            while head is not None and head[0] == key:
                now, head = head, next(it, None)
                yield {"role": now[1], "text": now[2]}

        mine = turns()
        yield key, mine
        for _ in mine:  # what the caller left
            pass


def format_chat(rows: DataFrame, template: str = TEMPLATE, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The formatted pieces: conv_id, seq, piece, loss (inside a generation block).

    The pieces of a conversation in order of ``seq`` are its formatted text."""
    src = _arranged(rows, conv, turn, role, text)
    kind = rows.schema[conv].dataType.simpleString()

    def run(batches):
        render = compile_template(template, {"escape": escape})
        out, size = [], 0
        names = ["conv_id", "seq", "piece", "loss"]
        ckind = None

        def flush():
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], ckind), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.bool_())], names)

        def watched():
            nonlocal ckind
            for b in batches:
                ckind = b.schema.field(0).type
                yield b

        for key, turns in _conversations(watched()):
            for seq, (piece, loss) in enumerate(render({"messages": turns})):
                out.append((key, seq, piece, loss))
                size += len(piece) + 32
                if size > 4_000_000:
                    yield flush()
                    out, size = [], 0
        if out:
            yield flush()

    return src.mapInArrow(run, f"conv_id {kind}, seq long, piece string, loss boolean")


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of every formatted conversation, from its output alone.

    A narrow map over the pieces as :func:`format_chat` leaves them: a
    conversation's pieces stand in one partition, in order."""
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def run(batches):
        out, key, state, ckind = [], object(), None, None

        def done():
            n, turns, loss_n, loss, chars = state[1], state[2], state[3], state[4], state[5]
            return key, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars

        def flush():
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], ckind), *(pa.array(c, t) for c, t in zip(cols[1:], (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True))],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            ckind = b.schema.field(0).type
            for k, seq, piece, loss in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if seq == 0:
                    if state is not None:
                        out.append(done())
                        if len(out) >= 10_000:
                            yield flush()
                            out = []
                    key, state = k, [Reader(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[5] += len(piece)
                for role, text in state[0].feed(piece):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                if loss:
                    text = unescape(piece)
                    state[3] += len(text)
                    state[4].update(text.encode())
        if state is not None:
            out.append(done())
        if out:
            yield flush()

    return pieces.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


PROBE = "</s>[INST] ok [/INST]"


def op5(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(f"SELECT id AS conv_id, turn, role, '{PROBE}' AS text FROM VALUES (-1L, 0L, 'user'), (-1L, 1L, 'assistant') AS t(id, turn, role)")
    return read_back(format_chat(rows.unionByName(probe)))


_SQL_PATTERN = ESCAPED.replace("(?![\\s\\S])", "").replace("'", "''").replace(")$", ")\\z")
OP5_SQL = rf"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
sized AS (SELECT *, length(regexp_replace(text, '{_SQL_PATTERN}', 'XX', 'g')) AS n, length(regexp_replace(role, '{_SQL_PATTERN}', 'XX', 'g')) AS r FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(n + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 15 WHEN 'assistant' THEN 4 ELSE 17 + r END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
