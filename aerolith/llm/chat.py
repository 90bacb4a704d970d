"""Chat formatting: roles recovered from transcripts by a hidden Markov model
(operator 1)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialise

ROLES = ("system", "user", "assistant")
START, STATES = len(ROLES), len(ROLES) + 1
NEVER = -1e9
#: Stands for a null conversation id or turn, so that it sorts first.
MISSING = -(2**63)
# The names under which speakers occur in transcripts.
NAMES = {
    "system": "system", "context": "system", "instruction": "system", "instructions": "system", "developer": "system",
    "user": "user", "human": "user", "question": "user", "q": "user", "customer": "user", "client": "user", "prompter": "user", "me": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant", "chatbot": "assistant",
    "answer": "assistant", "a": "assistant", "agent": "assistant", "response": "assistant",
}
MARKER = re.compile(
    r"^\s*(?:#{1,4}\s*|\*\*|<\|?|\[)?(%s)(?:\*\*\s*:|:\s*\*\*|\|?>|\]\s*:?|\s*:)\s*" % "|".join(sorted(NAMES, key=len, reverse=True)), re.I
)
#: Line features: (first line of its row) x (question mark) x (length class) x (list or code mark).
FEATURES = 2 * 2 * 4 * 2
#: How far a marker is trusted: log odds of naming the true role rather than one of the others.
TRUST = float(np.log(0.98 / 0.01))


def named_role(name: str | None) -> int:
    """Index of the role that a speaker's name stands for, -1 for none."""
    role = NAMES.get((name or "").strip().lower())
    return ROLES.index(role) if role else -1


def feature(line: str, first: bool) -> int:
    size = min(3, len(line) // 80)
    mark = bool(re.match(r"\s*(?:[-*•]\s|\d+[.)]\s|```|    )", line))
    return ((int(first) * 2 + ("?" in line)) * 4 + size) * 2 + int(mark)


def parse(text: str | None) -> tuple[list[str], list[int], list[int]]:
    """Lines of one row without their markers, the role each marker names (-1: none)
    and the feature of each line."""
    lines, marks, features = [], [], []
    for k, line in enumerate((text or "").split("\n")):
        m = MARKER.match(line)
        marks.append(named_role(m.group(1)) if m else -1)
        line = line[m.end() :] if m else line
        lines.append(line)
        features.append(feature(line, k == 0 or m is not None))
    return lines, marks, features


@dataclass
class Hmm:
    """Log probabilities over the roles and a state START before the first line:
    ``turn`` (from, to) applies at the first line of a row and at a marker, ``emit``
    is (state, feature).  Within a row and without a marker the role goes on."""

    turn: np.ndarray
    emit: np.ndarray

    def steps(self, marks: np.ndarray, features: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """Per line a (from, to) matrix: transition and emission."""
        stay = np.where(np.eye(STATES, dtype=bool), 0.0, -8.0)
        move = np.where((fresh | (marks >= 0))[:, None, None], self.turn[None], stay[None])
        emission = self.emit[:, features].T.copy()
        named = np.flatnonzero(marks >= 0)
        emission[named, marks[named]] += TRUST
        return move + emission[:, None, :]


def learns(conv_id: str = "conv_id") -> Column:
    """Conversations whose roles are read for training: a quarter, by a hash of the id."""
    return F.coalesce(F.pmod(F.crc32(F.col(conv_id).cast("string").cast("binary")), F.lit(4)) == 0, F.lit(False))


def train(conversations: DataFrame) -> Hmm:
    """Counts turns and line features where the row's role is known, over all rows given.

    What comes to the driver are two tables of fixed size (9 and 96 counts)."""
    role = F.lower(F.trim("role"))
    known = conversations.select("conv_id", "turn", "text", *[
        F.coalesce(*[F.when(role == name, r) for name, r in NAMES.items()]).alias("role")
    ]).where("role is not null")
    # the row before is that with the turn number one less, so no conversation is sorted in one task
    # rows of a place are counted by role before they meet, three at most a side
    placed = known.groupBy("conv_id", "turn", "role").agg(F.count("*").alias("n"))
    after = placed.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"), F.col("n").alias("m"))
    pairs = placed.join(after, ["conv_id", "turn"]).groupBy("before", "role").agg(F.sum(F.col("n") * F.col("m")).alias("count")).collect()
    turn = np.ones((STATES, len(ROLES)))
    for r in pairs:
        turn[ROLES.index(r["before"]), ROLES.index(r["role"])] += r["count"]
    for r in known.where("turn = 0").groupBy("role").count().collect():
        turn[START, ROLES.index(r["role"])] += r["count"]

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = np.zeros((len(ROLES), FEATURES), np.int64)
            for role, text in zip(batch["role"], batch["text"], strict=True):
                _, marks, features = parse(text)
                if max(marks) < 0:  # rows of a single speaker
                    np.add.at(counts[ROLES.index(role)], features, 1)
            r, f = counts.nonzero()
            yield pd.DataFrame({"r": r, "f": f, "n": counts[r, f]})

    emit = np.ones((len(ROLES), FEATURES))
    seen = known.select("role", "text").mapInPandas(lines, "r int, f int, n long")
    for r in seen.groupBy("r", "f").agg(F.sum("n").alias("n")).collect():
        emit[r["r"], r["f"]] += r["n"]
    norm = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return Hmm(
        np.hstack([norm(turn), np.full((STATES, 1), NEVER)]),
        np.vstack([norm(emit), np.full((1, FEATURES), NEVER)]),
    )


def stretches(frame: pd.DataFrame) -> np.ndarray:
    """Where rows of another conversation begin."""
    conv = frame["conv_id"].to_numpy()
    return np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))


def observed(hmm: Hmm, frame: pd.DataFrame) -> tuple[list, np.ndarray, np.ndarray]:
    """The parsed rows, the first line of each row (and the number of lines), the steps."""
    parsed = [parse(t) for t in frame["text"]]
    edges = np.cumsum([0, *(len(p[0]) for p in parsed)])
    fresh = np.zeros(edges[-1], bool)
    fresh[edges[:-1]] = True
    marks, features = (np.array([x for p in parsed for x in p[k]], np.int64) for k in (1, 2))
    return parsed, edges, hmm.steps(marks, features, fresh)


def best_paths(steps: np.ndarray, starts: np.ndarray, lens: np.ndarray, enter: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """Viterbi over many stretches at once: the state of every line.  ``enter`` is the
    state before a stretch, ``leave`` the one at its end (-1: the best)."""
    order = np.argsort(-lens, kind="stable")
    starts, lens = starts[order], lens[order]
    score = np.full((len(lens), STATES), -np.inf)
    score[np.arange(len(lens)), enter[order]] = 0.0
    back = np.empty((len(steps), STATES), np.int8)
    live = np.searchsorted(-lens, -np.arange(lens[0]), side="left") if len(lens) else []
    for t, k in enumerate(live):  # the k longest have a line t
        total = score[:k, :, None] + steps[starts[:k] + t]
        back[starts[:k] + t] = total.argmax(axis=1)
        score[:k] = total.max(axis=1)
    state = np.where(leave[order] >= 0, leave[order], score.argmax(axis=1))
    path = np.empty(len(steps), np.int8)
    for t in range(len(live) - 1, -1, -1):
        at = starts[: live[t]] + t
        path[at] = state[: live[t]]
        state[: live[t]] = back[at, state[: live[t]]]
    return path


def borders(segments: list[tuple]) -> dict[tuple, tuple[int, int]]:
    """``{(place, conv_id): (enter, leave)}`` on the best path of each conversation, from
    the ``(conv_id, place, matrix)`` of its stretches."""
    out = {}
    by_conv: dict[int, list] = {}
    for conv, place, m in sorted(segments, key=lambda s: s[:2]):
        by_conv.setdefault(conv, []).append((place, np.array(m).reshape(STATES, STATES)))
    for conv, parts in by_conv.items():
        score = np.full(STATES, -np.inf)
        score[START] = 0.0
        back = []
        for _, m in parts:
            total = score[:, None] + m
            back.append(total.argmax(axis=0))
            score = total.max(axis=0)
        state = int(score.argmax())
        for (place, _), b in zip(reversed(parts), reversed(back), strict=True):
            out[place, conv] = (int(b[state]), state)
            state = int(b[state])
    return out


def format_chats(conversations: DataFrame, model: Hmm | None = None) -> DataFrame:
    """Turns of all conversations with recovered roles, rendered canonically.

    Each row's text is parsed into lines; speaker markers (a name at a line's start) and
    line features are what a hidden Markov model over system, user and assistant emits.
    Its most likely path (Viterbi) gives each line's role; consecutive lines of a row
    with one role are a turn, rendered as ``<|role|>``, the text and ``<|end|>`` on lines
    of their own.  The ``role`` column is no emission: it is read only to train the
    model, on the quarter of the conversations that ``learns`` names, if none is given.

    A conversation is never gathered: rows are range-partitioned by (conv_id, turn).  A
    partition's first and last conversations may go on in others; their stretches are
    reduced to one roles x roles matrix each, and the matrices, at most two for each
    partition, give the roles at the borders.  The result is the path that Viterbi finds
    over the whole conversation.

    Returns ``conv_id, turn, part, role, text, rendered``.  Defined cases: null text
    is one empty line; null conv_id counts as one conversation, null turn sorts first;
    ties in turn go by a hash of the text; repeated rows each give their turns; an empty
    table gives an empty result; further columns are not read.
    """
    hmm = model or train(conversations.where(learns()))
    missing = F.lit(MISSING)
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), missing).alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), missing).alias("turn"),
        "text",
    )
    # the text's hash splits a conversation even where its turns are not numbered
    order = ["conv_id", "turn", F.xxhash64("text")]
    placed = materialise(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id())
    )
    # two conversations for each partition come to the driver, whatever the rows
    ends = placed.groupBy("place").agg(F.min("conv_id").alias("lo"), F.max("conv_id").alias("hi")).collect()
    places: dict[int, set[int]] = {}
    for e in ends:
        for conv in (e["lo"], e["hi"]):
            places.setdefault(conv, set()).add(e["place"])
    cut = [(place, conv) for conv, where in places.items() if len(where) > 1 for place in where]

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One matrix for each place and conversation; batches come in order."""
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for key, part in batch.groupby(["place", "conv_id"], sort=False):
                steps = observed(hmm, part)[2]
                if key in held:
                    steps = np.concatenate([held[key][None], steps])
                while len(steps) > 1:  # pairwise, as taking the best over the state between is associative
                    even = len(steps) // 2 * 2
                    joined = (steps[0:even:2, :, :, None] + steps[1:even:2, None, :, :]).max(axis=2)
                    steps = np.concatenate([joined, steps[even:]])
                held[key] = steps[0]
        yield pd.DataFrame([(c, p, m.ravel().tolist()) for (p, c), m in held.items()], columns=["conv_id", "place", "m"])

    known: dict[tuple, tuple[int, int]] = {}
    if cut:
        wanted = conversations.sparkSession.createDataFrame(cut, "place int, conv_id long")
        across = placed.join(F.broadcast(wanted), ["place", "conv_id"]).repartition("place").sortWithinPartitions("place", "at")
        known = borders([tuple(r) for r in across.mapInPandas(reduce, "conv_id long, place int, m array<double>").collect()])

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(places_in := held["place"].unique()) > 1:  # a task can hold several places
                inside = held["place"] == places_in[0]
                yield rendered(held[inside].reset_index(drop=True))
                held = held[~inside].reset_index(drop=True)
            last = stretches(held)[-1]
            if last >= 5_000:  # all but the last conversation is complete
                yield rendered(held[:last])
                held = held[last:].reset_index(drop=True)
        if held is not None and len(held):
            yield rendered(held)

    def rendered(frame: pd.DataFrame) -> pd.DataFrame:
        parsed, edges, steps = observed(hmm, frame)
        first = stretches(frame)
        starts = edges[first]
        lens = np.diff(np.append(starts, edges[-1]))
        keys = zip(frame["place"].to_numpy()[first].tolist(), frame["conv_id"].to_numpy()[first].tolist(), strict=True)
        sides = np.array([known.get(key, (START, -1)) for key in keys])
        path = best_paths(steps, starts, lens, sides[:, 0], sides[:, 1])
        turned = np.concatenate([[True], path[1:] != path[:-1]])
        turned[edges[:-1]] = True
        at = np.flatnonzero(turned)
        row = np.searchsorted(edges, at, side="right") - 1
        part = np.arange(len(at)) - np.searchsorted(at, edges[row])
        until = np.append(at[1:], edges[-1])
        lines = [line for p in parsed for line in p[0]]
        texts = ["\n".join(lines[i:j]).strip() for i, j in zip(at.tolist(), until.tolist(), strict=True)]
        roles = [ROLES[k] for k in path[at].tolist()]
        return pd.DataFrame(
            {
                "conv_id": frame["conv_id"].to_numpy()[row], "turn": frame["turn"].to_numpy()[row], "part": part, "role": roles,
                "text": texts, "rendered": [f"<|{r}|>\n{t}\n<|end|>\n" for r, t in zip(roles, texts, strict=True)],
            }
        )

    ordered = placed.repartition("place").sortWithinPartitions("place", "at")
    turns = ordered.mapInPandas(decode, "conv_id long, turn long, part int, role string, text string, rendered string")
    return turns.withColumns({c: F.when(F.col(c) != missing, F.col(c)) for c in ("conv_id", "turn")})
