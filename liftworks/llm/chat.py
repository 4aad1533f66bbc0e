"""Operator 2: chat formatting with a hidden Markov model over transcript lines.

A transcript is plain text in which speakers may or may not be marked. Each line that isn't blank is
an observation (speaker marker, blank line before, question mark, length); the hidden states are
the roles, each as the start of a turn or as its continuation. Viterbi's best path gives the turns,
which are then rendered canonically.

The model's probabilities are counts over transcripts with known turns, summed by Spark. Of the query's
conversations those whose crc32(conv_id as text) mod 5 is 0 are held out of them.

A conversation of any length is one transcript. It is stored in *parts* of up to ``PART_TURNS`` turns or
``PART_BYTES``, in the order of a range partitioning, so that no task gathers a conversation. Viterbi's
path runs through the parts: each sends the best score between any state before it and any state at its
end (36 numbers and 6 starts), these are chained per conversation, and each part then finds its own stretch
of the path between the two states it is told. The rendered parts of a conversation, put together in order,
are its rendered text: a turn that goes on in the next part is closed there.

Null texts are empty; a transcript without lines has no turns and renders empty, as do parts of blank lines
before the first turn. Rows with a null conversation id are one conversation; null turns come first, null or
unknown roles count as user. Turns of the same number are ordered by role and a hash of the text; equal rows
stay. Extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from liftworks.sources import release, stage

ROLES = ("user", "assistant", "system")
#: Turns of a part, by their numbers, and its bytes of text.
PART_TURNS = 4096
PART_BYTES = 16 << 20
#: Rows and bytes of a range of parts, and rows of a part's numbers from which on ranges may cut it.
RANGE_ROWS, RANGE_BYTES, CROWDED = 100_000, 64 << 20, 100_000
STATES = 2 * len(ROLES)  # role * 2, + 1 for a continuation

#: Names that speakers go by.
NAMES = {
    "user": 0, "human": 0, "q": 0, "question": 0, "customer": 0, "me": 0, "prompt": 0,
    "assistant": 1, "ai": 1, "bot": 1, "a": 1, "answer": 1, "model": 1, "agent": 1,
    "system": 2, "instruction": 2, "instructions": 2, "context": 2,
}
_MARK = re.compile(r"\s*[#*\[<|>(-]*\s*([A-Za-z]{1,12})\s*[\]>|*)]*\s*[:>]\s*[*]*\s*")
_OTHER, _NONE = len(ROLES), len(ROLES) + 1
_SIZES = (len(ROLES) + 2, 2, 2, 3)  # values of each feature


def marker(line: str) -> tuple[int, int]:
    """Kind of speaker marker at the start of a line, and where the text behind it starts."""
    m = _MARK.match(line)
    if not m:
        return _NONE, 0
    kind = NAMES.get(m[1].lower(), _OTHER)
    return kind, m.end() if kind != _OTHER else 0


def text_start(line: str) -> int:
    """Where a turn's text starts in its first line: behind its marker and one space."""
    end = marker(line)[1]
    head = line[:end].rstrip()
    if end and "*" not in line[: _MARK.match(line).start(1)]:
        head = head.rstrip("* \t")  # stars behind a plain marker are the text's own
    return min(end, len(head) + 1)


def observe(text: str, blank: bool = False) -> tuple[list[str], np.ndarray]:
    """Lines that aren't blank, and their features; ``blank`` tells of a blank line before the text."""
    lines, rows = [], []
    for line in text.split("\n"):
        if not line.strip():
            blank = True
            continue
        n = len(line)
        rows.append((marker(line)[0], blank, line.rstrip().endswith("?"), (n > 40) + (n > 160)))
        lines.append(line)
        blank = False
    return lines, np.array(rows, dtype=np.int64).reshape(-1, len(_SIZES))


def states_of(turns: list[tuple[int, int]]) -> np.ndarray:
    """States of (role, lines) turns."""
    out = [2 * role + (k > 0) for role, n in turns for k in range(n)]
    return np.array(out, dtype=np.int64)


class Model:
    """Log probabilities of starts, transitions and features, add-one smoothed."""

    def __init__(self, counts: np.ndarray):
        sizes = [STATES, STATES * STATES, *[STATES * s for s in _SIZES]]
        parts = np.split(counts + 1.0, np.cumsum(sizes)[:-1])
        cont = np.arange(STATES) % 2 == 1
        start, step = parts[0], parts[1].reshape(STATES, STATES)
        start = np.where(cont, 0, start)  # a continuation needs its own role before it
        role = np.arange(STATES) // 2
        step = np.where(cont[None, :] & (role[None, :] != role[:, None]), 0, step)
        with np.errstate(divide="ignore"):
            self.start = np.log(start / start.sum())
            self.step = np.log(step / step.sum(axis=1, keepdims=True))
        self.features = [
            np.log(p.reshape(STATES, -1) / p.reshape(STATES, -1).sum(axis=1, keepdims=True))
            for p in parts[2:]
        ]

    def _emitted(self, seen: np.ndarray) -> np.ndarray:
        return sum(f[:, seen[:, k]] for k, f in enumerate(self.features)).T

    def best(self, seen: np.ndarray, entry: int | None = None, end: int | None = None) -> np.ndarray:
        """Viterbi's path, after state ``entry`` and to state ``end`` if they are given; of equal ones that
        with the smaller states."""
        if not len(seen):
            return np.zeros(0, dtype=np.int64)
        emitted = self._emitted(seen)
        score = (self.start if entry is None else self.step[entry]) + emitted[0]
        back = np.zeros((len(seen), STATES), dtype=np.int8)
        for t in range(1, len(seen)):
            paths = score[:, None] + self.step
            back[t] = paths.argmax(axis=0)
            score = paths.max(axis=0) + emitted[t]
        path = np.empty(len(seen), dtype=np.int64)
        path[-1] = score.argmax() if end is None else end
        for t in range(len(seen) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path

    def message(self, seen: np.ndarray) -> np.ndarray:
        """Best scores of a part: row s from state s before it, the last row from a start; columns are the
        states at its end. Empty if the part has no line."""
        if not len(seen):
            return np.zeros((0, STATES))
        emitted = self._emitted(seen)
        score = np.vstack([self.step, self.start]) + emitted[0]
        for line in emitted[1:]:
            score = (score[:, :, None] + self.step[None]).max(axis=1) + line
        return score


def chained(messages: list[np.ndarray]) -> list[tuple[int | None, int | None]]:
    """(state before, state at the end) of each part of a conversation on the best path through all."""
    score, back, at = None, [], []
    for k, m in enumerate(messages):
        if not len(m):
            continue
        if score is None:
            back.append(None)
            score = m[STATES]
        else:
            paths = score[:, None] + m[:STATES]
            back.append(paths.argmax(axis=0).astype(np.int8))
            score = paths.max(axis=0)
        at.append(k)
    out: list[tuple[int | None, int | None]] = [(None, None)] * len(messages)
    state = None if score is None else int(score.argmax())
    for k, b in zip(reversed(at), reversed(back)):
        before = None if b is None else int(b[state])
        out[k] = (before, state)
        state = before
    for k in range(1, len(out)):  # parts without lines pass the state on
        if not len(messages[k]):
            out[k] = (out[k - 1][1], out[k - 1][1])
    return out


def counts_of(seen: np.ndarray, states: np.ndarray, before: int | None = None) -> np.ndarray:
    """Counts that a transcript with known states, after state ``before`` if any, adds to a model."""
    start, step = np.zeros(STATES), np.zeros(STATES * STATES)
    if len(states):
        if before is None:
            start[states[0]] += 1
        else:
            step[before * STATES + states[0]] += 1
        np.add.at(step, states[:-1] * STATES + states[1:], 1)
    parts = [
        np.bincount(states * size + seen[:, k], minlength=STATES * size)
        for k, size in enumerate(_SIZES)
    ]
    return np.concatenate([start, step, *parts])


#: Speaker names of each transcript style; the last style has none.
_STYLES = (
    ("User: ", "Assistant: ", "System: "),
    ("Human: ", "AI: ", "System: "),
    ("Q: ", "A: ", "Context: "),
    ("### user: ", "### assistant: ", "### system: "),
    ("", "", ""),
)


def compose(turns: list[tuple[int, str]], seed: int, first: bool = True) -> tuple[str, list[tuple[int, int]]]:
    """A transcript of (role, text) turns and the (role, lines) of each.

    ``seed`` picks the style and which turns lack their marker; those follow a blank line, but not the
    ``first``. A turn that is blank, or that begins like a marker of its own, always has a marker, of the
    first style if its own has none: nothing else would show it, or keep its beginning.
    """
    style, out, known = _STYLES[seed % len(_STYLES)], [], []
    for k, (role, text) in enumerate(turns):
        begins = first and not k
        mark = style[role] if (seed >> 3) + zlib.crc32(text.encode()) & 7 or begins else ""
        line = next((x for x in text.split("\n") if x.strip()), "")
        if not line or not mark and marker(line)[1]:
            mark = style[role] or _STYLES[0][role]
        out.append(("" if mark or begins else "\n") + mark + text)
        known.append((role, len(observe(mark + text)[0])))
    return "\n".join(out), known


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_PARTS = [
    ("range", "int", pa.int32()), ("seq", "int", pa.int32()), ("conv_id", "long", pa.int64()),
    ("nth", "long", pa.int64()), ("final", "boolean", pa.bool_()), ("before", "int", pa.int32()),
    ("before_blank", "boolean", pa.bool_()), ("tail", "int", pa.int32()), ("tail_blank", "boolean", pa.bool_()),
    ("turns", "array<struct<role string, text string>>", _TURNS),
]
_RAW = [
    ("range", "int", pa.int32()), ("seq", "int", pa.int32()), ("conv_id", "long", pa.int64()),
    ("part", "long", pa.int64()), ("last", "boolean", pa.bool_()), ("before", "int", pa.int32()),
    ("blank", "boolean", pa.bool_()), ("text", "string", pa.string()),
    ("states", "array<long>", pa.list_(pa.int64())),
]


def _ddl(columns: list[tuple]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind, _ in columns)


def _batch(rows: list[tuple], columns: list[tuple]) -> pa.RecordBatch:
    values = list(zip(*rows)) or [[]] * len(columns)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kind) for v, (_, _, kind) in zip(values, columns)], names=[c[0] for c in columns]
    )


def _seed(conv: int | None) -> int:
    return zlib.crc32(str(conv).encode())


def gathered(
    conversations: DataFrame,
    part_turns: int = PART_TURNS,
    part_bytes: int = PART_BYTES,
    crowded: int = CROWDED,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Parts of all conversations, in order of (range, seq), with the columns of ``_PARTS``.

    ``nth`` numbers a conversation's parts within a range; ``final`` says that no other follows there.
    ``tail`` is the state of a part's last line and ``tail_blank`` tells whether it ends with a blank one;
    ``before`` and ``before_blank`` are those of the part before in the same range.
    Ranges hold whole blocks of ``part_turns`` turn numbers, but for blocks of over ``crowded`` rows
    (repeated or null numbers) or a 4,096th of all rows: those are cut wherever a range ends.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.floor(F.coalesce("turn", F.lit(0)) / part_turns).cast("long").alias("block"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.lower(F.col("role").cast("string")), F.lit("user")).alias("role"),
        text.alias("text"),
        F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("number"),
    )
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    least = max(crowded, size["n"] // 4096)  # so at most 4,096 blocks are crowded
    group = F.xxhash64("conv", "block")
    blocks = rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    full = [r[0] for r in blocks.select(group).collect()]
    cut = group.isin(full) if full else F.lit(False)
    ranges = size["n"] // range_rows + (size["b"] or 0) // RANGE_BYTES + 1
    inner = [F.when(cut, F.col(c)) for c in ("turn", "role", "hash", "number")]
    dealt = rows.repartitionByRange(ranges, "conv", "block", *inner)
    ordered = dealt.sortWithinPartitions("conv", "block", "turn", "role", "hash")

    def run(batches):
        task, seq, nth, size, held, at, before = TaskContext.get().partitionId(), 0, 0, 0, [], None, (None, None)

        def part(goes_on):
            nonlocal seq, nth, size, held, before
            turns = _known(held[-1:])
            text, known = compose(turns, _seed(at[0]), nth == 0 and len(held) == 1)
            tail = (int(states_of(known)[-1]), not text.split("\n")[-1].strip())
            row = (task, seq, at[0], nth, not goes_on, *before, *tail, held)
            before = tail if goes_on else (None, None)
            seq, nth, size, held = seq + 1, nth + 1 if goes_on else 0, 0, []
            return _batch([row], _PARTS)

        for b in batches:
            for conv, block, role, text in zip(*[c.to_pylist() for c in b.columns]):
                if held and (at != (conv, block) or len(held) >= part_turns or size >= part_bytes):
                    yield part(at[0] == conv)
                at, size = (conv, block), size + len(text)
                held.append({"role": role, "text": text})
        if held:
            yield part(False)

    return ordered.select("conv", "block", "role", "text").mapInArrow(run, _ddl(_PARTS))


def borders(parts: DataFrame) -> tuple[dict[int, tuple], dict[int, int]]:
    """By range, the conversation that goes on from earlier ranges, its parts there and how they end; and by
    range, the ``seq`` of the last part if its conversation goes on. One row per range is collected."""
    seen = parts.groupBy("range").agg(
        F.min_by("conv_id", "seq").alias("first"),
        F.max_by("conv_id", "seq").alias("last"),
        F.max_by("nth", "seq").alias("nth"),
        F.max("seq").alias("seq"),
        F.max_by("tail", "seq").alias("tail"),
        F.max_by("tail_blank", "seq").alias("blank"),
    )
    heads, tails, held = {}, {}, None
    for r in sorted(seen.collect(), key=lambda r: r["range"]):
        n = r["nth"] + 1
        if held and r["first"] == held["last"]:
            heads[r["range"]] = (r["first"], total, held["tail"], held["blank"])
            tails[held["range"]] = held["seq"]
            n += total if r["last"] == r["first"] else 0
        held, total = r, n
    return heads, tails


def _known(turns) -> list[tuple[int, str]]:
    index = {r: i for i, r in enumerate(ROLES)}
    return [(index.get(t["role"], 0), t["text"]) for t in turns]


def transcripts(parts: DataFrame) -> DataFrame:
    """Raw transcripts by part with their true states, columns of ``_RAW``; ``parts`` are read twice.

    ``before`` is the true state before a later part, ``blank`` whether a blank line stands there.
    """
    heads, tails = borders(parts)

    def run(batches):
        for b in batches:
            rows = []
            for at, seq, conv, nth, final, before, blank, _, _, turns in zip(*[c.to_pylist() for c in b.columns]):
                if at in heads and heads[at][0] == conv:
                    before, blank = (before, blank) if nth else heads[at][2:]
                    nth += heads[at][1]
                last = final and tails.get(at) != seq
                text, known = compose(_known(turns), _seed(conv), nth == 0)
                rows.append((at, seq, conv, nth, last, before, bool(blank), text, states_of(known).tolist()))
            yield _batch(rows, _RAW)

    return parts.select([c[0] for c in _PARTS]).mapInArrow(run, _ddl(_RAW))


def fit(known: DataFrame) -> Model:
    """Model from ``transcripts``; the counts of all rows are added up in Spark."""

    def run(batches):
        total = np.zeros(STATES + STATES * STATES + STATES * sum(_SIZES))
        for b in batches:
            for text, states, before, blank in zip(*[c.to_pylist() for c in b.columns]):
                total += counts_of(observe(text, blank)[1], np.array(states, dtype=np.int64), before)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total[at].astype(np.int64))], names=["at", "n"]
        )

    rows = known.select("text", "states", "before", "blank").mapInArrow(run, "at long, n long")
    counts = np.zeros(STATES + STATES * STATES + STATES * sum(_SIZES))
    for r in rows.groupBy("at").agg(F.sum("n").alias("n")).collect():  # one row per parameter
        counts[r["at"]] = r["n"]
    return Model(counts)


def blank_before(text: str) -> tuple[list[list[str]], list[str]]:
    """The blank lines before each line that isn't blank, and those after the last one."""
    out, held = [], []
    for line in text.split("\n"):
        if line.strip():
            out.append(held)
            held = []
        else:
            held.append(line)
    return out, held


def turns_of(
    text: str, model: Model, entry: int | None = None, end: int | None = None, blank: bool = False
) -> list[tuple[str | None, str]]:
    """(role, text) turns of a transcript; speaker markers at a turn's start are cut off.

    Blank lines within a turn stay, as do those after it, but for the one that stands before an
    unmarked turn, which is the transcript's own sign of a new turn. Of a marker's spaces one is cut.
    With ``entry``, the state before a later part, the first turn has no role: it goes on from the part
    before, and its text begins with a newline or is empty.
    """
    lines, seen = observe(text, blank)
    blanks, after = blank_before(text)
    out: list[tuple[str | None, list[str]]] = [] if entry is None else [(None, [""])]
    for line, state, before in zip(lines, model.best(seen, entry, end).tolist(), blanks):
        cut = marker(line)[1]
        if state % 2 == 0 or not out:
            if out:
                out[-1][1].extend(before if cut else before[:-1])
                before = []
            out.append((ROLES[state // 2], [*before, line[text_start(line) :]]))
        else:
            out[-1][1].extend([*before, line])
    if out:
        out[-1][1].extend(after)
    return [(role, "\n".join(rest)) for role, rest in out]


def render(turns: list[tuple[str | None, str]], last: bool = True) -> str:
    """Canonical text of turns; that of a part that isn't the ``last`` leaves its last turn open."""
    out = [text if role is None else f"<|{role}|>\n{text}" for role, text in turns]
    return "\n<|end|>\n".join(out) + ("\n<|end|>\n" if last and turns else "")


def path_states(raw: DataFrame, model: Model) -> DataFrame:
    """(range, seq, entry, end): the states around each part of conversations that have several.

    A conversation's messages meet in one task: 42 numbers for each of its parts of thousands of turns.
    """

    def send(batches):
        for b in batches:
            texts, blanks = b.column(4).to_pylist(), b.column(5).to_pylist()
            sent = [model.message(observe(t or "", k)[1]).ravel().tolist() for t, k in zip(texts, blanks)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(sent, pa.list_(pa.float64()))],
                names=["range", "seq", "conv_id", "part", "message"],
            )

    def chain(pdf):
        pdf = pdf.sort_values("part", ignore_index=True)
        pairs = chained([np.array(m, dtype=float).reshape(-1, STATES) for m in pdf["message"]])
        out = pdf[["range", "seq"]].copy()
        out["entry"], out["end"] = [[-1 if p[i] is None else p[i] for p in pairs] for i in (0, 1)]
        return out

    messages = raw.select("range", "seq", "conv_id", "part", "text", "blank").mapInArrow(
        send, "range int, seq int, conv_id long, part long, message array<double>"
    )
    return messages.groupBy("conv_id").applyInPandas(chain, "range int, seq int, entry int, end int")


_PARSED = [
    ("conv_id", "long", pa.int64()), ("part", "long", pa.int64()), ("n_turns", "long", pa.int64()),
    ("roles", "string", pa.string()), ("rendered", "string", pa.string()),
]


def parse(raw: DataFrame, model: Model) -> DataFrame:
    """(conv_id, part, n_turns, roles, rendered) of transcripts (columns of ``_RAW``; ``before`` and
    ``states``, the truth, are not read).

    ``n_turns`` and ``roles`` count the turns that start in the part.
    """

    def run(batches):
        for b in batches:
            rows = []
            for conv, part, last, text, blank, entry, end in zip(*[c.to_pylist() for c in b.columns]):
                around = [None if s is None or s < 0 else s for s in (entry, end)]
                turns = turns_of(text or "", model, *around, blank)
                roles = [r for r, _ in turns if r is not None]
                rows.append((conv, part, len(roles), ",".join(roles), render(turns, last)))
            yield _batch(rows, _PARSED)

    kept = ["conv_id", "part", "last", "text", "blank"]
    alone = (F.col("part") == 0) & F.col("last")
    none = F.lit(None).cast("int")
    whole = raw.filter(alone).select(*kept, none.alias("entry"), none.alias("end"))
    several = raw.filter(~alone)
    told = several.join(path_states(several, model), ["range", "seq"]).select(*kept, "entry", "end")
    return whole.unionByName(told).mapInArrow(run, _ddl(_PARSED))


def held_out(conv_id: str = "conv_id"):
    """Whether a conversation is kept out of the fit."""
    return F.crc32(F.coalesce(F.col(conv_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def format_conversations(conversations: DataFrame, **layout) -> DataFrame:
    """Raw transcripts of ``conversations``, parsed again by a model fitted on those not held out."""
    parts = stage(gathered(conversations, **layout), "chat-parts")
    raw = stage(transcripts(parts), "chat-raw")
    release(parts)
    model = fit(raw.filter(~held_out()))
    return parse(raw, model).withColumn("held_out", held_out())
