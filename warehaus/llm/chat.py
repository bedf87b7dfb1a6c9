"""Transcript parsing: roles and turns recovered by a hidden Markov model.

A transcript is a sequence of text pieces of one conversation.  Its lines are
observed by their speaker marker (a role word in one of the usual notations, an
unknown name, a quote sign, none), by line features (length class, question,
list item) and by whether they begin a piece.  The hidden states are role x (first line of a turn, further line).
Start, transition and emission probabilities are counted from labelled lines by
Spark aggregates (how often a turn begins at or inside a piece is fixed, as labelled
pieces are whole turns); Viterbi finds the best state sequence; a turn is a first line
with the further lines behind it, and is rendered in one canonical form.

Scale: lines are ordered by a range partitioning on (conversation, position,
row), so a conversation with a third of all rows spreads over many tasks.  Only
the first and last conversation of a partition can go on in another one.  Each
such fragment is summed up by its max-plus transfer matrix (6 x 6); per
conversation, Viterbi over its fragments (at most one per partition) fixes the
states at their ends, and every fragment is then decoded between fixed ends.
That is the exact best path.  What reaches the driver is two rows per partition.

Defined results: a null text is one empty line; a null conversation is one
conversation of its own; pieces with equal positions follow in input order;
repeated rows are repeated pieces; of equally good paths that with the earlier
role (in the order system, user, assistant) is taken; a very long piece is cut
into its lines; a piece without any marker is a turn of its own, whose role
follows from its neighbours; roles other than the known ones (or null)
are not learned from; without labelled lines fixed counts alone are used; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warehaus.llm.common import small_batches, stored

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # 2 * role: first line; 2 * role + 1: further line
# Usual words for the roles in speaker markers.
WORDS = {"system": "system sys instruction instructions context", "user": "user human question q prompt prompter customer",
         "assistant": "assistant ai bot answer a gpt model chatbot response"}
WORD_ROLE = {w: ROLES.index(r) for r, ws in WORDS.items() for w in ws.split()}
MARKERS = (*ROLES, "name", "quote", "none")
NOTATION = re.compile(
    r"\s*(?:<\|\s*(?P<pipe>\w+)\s*\|>|\[\s*(?P<square>[A-Za-z]\w*)\s*\]\s*:?|#{1,6}\s*(?P<hash>\w+)\s*:?\s*$"
    r"|(?:\*\*)?(?P<colon>[A-Za-z][\w.-]{0,19})(?:\*\*)?\s*:(?=\s|$)|(?P<quote>>))\s*")
ITEM = re.compile(r"\s*(?:[-*•]|\d{1,3}[.)])\s")
LENGTHS = (0, 40, 120, 300, 700)
SMOOTHING = 0.5
LINE_SCHEMA = ("conv {kind}, turn long, row long, line int, text string, marker int, length int, question int, item int, "
               "role int")
# P(begins a piece | first line), P(begins a piece | further line): not learned, see above.
HEAD = (0.8, 0.002)
FEATURES = {"marker": len(MARKERS), "length": len(LENGTHS) + 1, "question": 2, "item": 2}


def observe(line: str) -> tuple[str, int, int, int, int]:
    """(text without marker, marker, length class, question, list item) of one line."""
    kind, text = len(MARKERS) - 1, line
    m = NOTATION.match(line)
    if m:
        if m["quote"]:
            kind, text = MARKERS.index("quote"), line[m.end():]
        else:
            word = next(x for x in (m["pipe"], m["square"], m["hash"], m["colon"]) if x).lower()
            role = WORD_ROLE.get(word)
            if role is not None or m["colon"]:
                kind, text = (MARKERS.index("name") if role is None else role), line[m.end():]
    size = sum(len(text) > x for x in LENGTHS)
    return text, kind, size, int(text.rstrip().endswith("?")), int(bool(ITEM.match(text)))


class Model:
    """Log probabilities: start (states), move (states x states), and one table per feature."""

    def __init__(self, start: dict[int, float], move: dict[tuple[int, int], float],
                 seen: dict[str, dict[tuple[int, int], float]]):
        def table(counts: dict, rows: int, cols: int, prior=lambda i, j: SMOOTHING) -> np.ndarray:
            t = np.array([[prior(i, j) for j in range(cols)] for i in range(rows)], float)
            for (i, j), n in counts.items():
                t[i, j] += n
            return np.log(t / t.sum(axis=1, keepdims=True))

        def may(i: int, j: int) -> float:
            """A further line only follows a line of its own turn; without counts speakers alternate."""
            if j % 2:
                return SMOOTHING if i // 2 == j // 2 else 1e-9
            return SMOOTHING if i // 2 != j // 2 else SMOOTHING / 10

        def says(i: int, j: int) -> float:
            """A role word marks a first line of its role."""
            return 1.0 if (j < len(ROLES) and j == i // 2 and i % 2 == 0) or j == len(MARKERS) - 1 else SMOOTHING / 10

        self.start = table({(0, s): n for s, n in start.items()}, 1, STATES, lambda i, j: 1e-9 if j % 2 else SMOOTHING)[0]
        self.move = table(move, STATES, STATES, may)
        self.seen = {f: table(seen.get(f, {}), STATES, n, says if f == "marker" else lambda i, j: SMOOTHING)
                     for f, n in FEATURES.items()}

    def emission(self, lines: pd.DataFrame) -> np.ndarray:
        head = np.log(np.array([[1 - p, p] for p in HEAD] * len(ROLES)))  # state x begins a piece
        return sum(self.seen[f][:, lines[f].to_numpy()].T for f in FEATURES) + head[:, (lines["line"].to_numpy() == 0).astype(int)].T

    def transfer(self, emission: np.ndarray, first: bool) -> np.ndarray:
        """Best score of going from the state before the lines to each last state.

        At a conversation's first line the state before does not matter.
        """
        m = None
        for k, e in enumerate(emission):
            step = (np.broadcast_to(self.start, (STATES, STATES)) if first and k == 0 else self.move) + e
            m = step if m is None else (m[:, :, None] + step[None]).max(axis=1)
        return m

    def decode(self, emission: np.ndarray, before: int | None, end: int | None) -> np.ndarray:
        """Best states of consecutive lines, between a state before and a last state where these are fixed."""
        n = len(emission)
        back = np.empty((n, STATES), np.int64)
        score = (self.start if before is None else self.move[before]) + emission[0]
        for k in range(1, n):
            way = score[:, None] + self.move
            back[k] = way.argmax(axis=0)
            score = way.max(axis=0) + emission[k]
        states = np.empty(n, np.int64)
        states[-1] = int(score.argmax()) if end is None else end
        for k in range(n - 1, 0, -1):
            states[k - 1] = back[k, states[k]]
        return states


# --------------------------------------------------------------------- Spark

def lines_of(df: DataFrame, conv_col: str, turn_col: str, text_col: str, role: Column | None = None) -> DataFrame:
    """Observed lines in order, cut into the partitions of one range partitioning (column ``part``)."""
    small_batches(df.sparkSession)
    known = F.lit(None) if role is None else F.array_position(F.array(*map(F.lit, ROLES)), role) - 1
    rows = stored(df.select(df[conv_col].alias("conv"), df[turn_col].cast("long").alias("turn"),
                            F.monotonically_increasing_id().alias("row"), df[text_col].alias("text"),
                            F.coalesce(known, F.lit(-1)).cast("int").alias("role")), "chat-rows")
    rows = rows.repartitionByRange("conv", "turn", "row").sortWithinPartitions("conv", "turn", "row")
    schema = LINE_SCHEMA.format(kind=dict(rows.dtypes)["conv"])
    names = [x.split()[0] for x in schema.split(", ")]

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [[observe(x) for x in (t or "").split("\n")] for t in part.column(3).to_pylist()]
                many = [len(x) for x in found]
                take = pa.array(np.repeat(np.arange(len(many)), many))
                flat = [y for x in found for y in x]
                made = {"line": [k for n in many for k in range(n)]} | {
                    n: [y[i] for y in flat] for i, n in enumerate(("text", "marker", "length", "question", "item"))}
                whole = {n: part.column(i).take(take) for i, n in ((0, "conv"), (1, "turn"), (2, "row"), (4, "role"))}
                yield pa.RecordBatch.from_arrays(
                    [whole[n] if n in whole else pa.array(made[n], pa.string() if n == "text" else pa.int32()) for n in names], names)

    laid = rows.mapInArrow(cut, schema).withColumn("part", F.spark_partition_id())
    return stored(laid, "chat-lines")


def learn(lines: DataFrame) -> Model:
    """Counts over all labelled lines; what is collected is bounded by states and feature values."""
    known = lines.where("role >= 0").withColumn("state", F.expr("2 * role + case when line = 0 then 0 else 1 end"))
    cells = known.groupBy("state", *FEATURES).agg(F.count("*").alias("n")).collect()
    seen: dict[str, dict] = {f: {} for f in FEATURES}
    for r in cells:
        for f in FEATURES:
            seen[f][r["state"], r[f]] = seen[f].get((r["state"], r[f]), 0) + r["n"]
    turns = known.groupBy("conv", "turn", "row", "role").agg(F.max("line").alias("further"))
    # Counts of repeated rows are multiplied, not paired: at most 18 pairs per conversation and turn.
    held = turns.groupBy("conv", "turn", "role", F.least("further", F.lit(1)).alias("f")).agg(F.count("*").cast("double").alias("n"))
    a = held.select(F.col("conv").alias("c"), F.col("turn").alias("at"), F.col("role").alias("r"), "f", "n")
    b = held.groupBy("conv", "turn", "role").agg(F.sum("n").alias("m")).select("conv", (F.col("turn") - 1).alias("before"), F.col("role").alias("s"), "m")
    pairs = a.join(b, F.col("c").eqNullSafe(F.col("conv")) & (F.col("at") == F.col("before")))
    move: dict[tuple[int, int], float] = {}

    def count(i: int, j: int, n: float) -> None:
        move[i, j] = move.get((i, j), 0) + n

    for r in pairs.groupBy("r", "s", "f").agg(F.sum(F.col("n") * F.col("m")).alias("n")).collect():
        count(2 * r["r"] + r["f"], 2 * r["s"], r["n"])
    for r in turns.groupBy("role").agg(F.sum(F.least("further", F.lit(1))).alias("one"), F.sum("further").alias("all")).collect():
        count(2 * r["role"], 2 * r["role"] + 1, r["one"])
        count(2 * r["role"] + 1, 2 * r["role"] + 1, r["all"] - r["one"])
    opened = turns.groupBy("conv").agg(F.min(F.struct("turn", "row", "role")).alias("first"))
    start = {2 * r["role"]: r["count"] for r in opened.groupBy("first.role").count().collect()}
    return Model(start, move, seen)


def _same_as_before(values: pd.Series) -> np.ndarray:
    """For every row but the first, whether it equals the one before (nulls are equal)."""
    now, before = values.iloc[1:], values.iloc[:-1]
    return (now.to_numpy() == before.to_numpy()) | (now.isna().to_numpy() & before.isna().to_numpy())


def _runs(frame: pd.DataFrame) -> np.ndarray:
    """Where runs of one conversation in one range partition begin in sorted lines, and the end."""
    same = _same_as_before(frame["conv"]) & _same_as_before(frame["part"])
    return np.concatenate([[0], np.flatnonzero(~same) + 1, [len(frame)]])


def _whole_runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """(lines, where the runs begin and the end): many whole runs at a time; the last ones when the partition ends."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        edge = pd.concat([held[-1].iloc[-1:], batch.iloc[[0, -1]]]) if held else None
        if edge is not None and len(_runs(edge)) == 2 and len(_runs(batch)) == 2:
            held.append(batch)  # all one run, which goes on
            continue
        frame = pd.concat([*held, batch], ignore_index=True)
        cuts = _runs(frame)
        if len(cuts) > 2:
            yield frame.iloc[:cuts[-2]], cuts[:-1]
        held = [frame.iloc[cuts[-2]:].reset_index(drop=True)]
    if held:
        frame = pd.concat(held, ignore_index=True)
        yield frame, _runs(frame)


def parse_lines(lines: DataFrame, model: Model) -> DataFrame:
    """Turns (conv, turn, line, role, n_lines, text, rendered); turn and line are those of the first line."""
    kind = dict(lines.dtypes)["conv"]
    spark = lines.sparkSession
    sent = spark.sparkContext.broadcast(model)
    # A fragment may go on elsewhere only if its conversation reaches into another partition.
    ends = lines.groupBy("part").agg(F.min(F.struct("conv", "turn", "row", "line")).alias("a"),
                                     F.max(F.struct("conv", "turn", "row", "line")).alias("b"))
    edge = ends.select("part", F.explode(F.array("a.conv", "b.conv")).alias("conv")).distinct()
    edge = edge.groupBy(F.col("conv").alias("c")).agg(F.sort_array(F.collect_list("part")).alias("parts")).where("size(parts) > 1")
    broken = {}  # at most two entries per partition
    for r in edge.collect():
        for p in r["parts"]:
            broken[p, r["c"]] = r["parts"]
    reach: dict[int, list] = {}
    for p, c in broken:
        reach.setdefault(p, []).append(c)
    cut = spark.sparkContext.broadcast(reach)
    laid = lines.repartitionByRange("part").sortWithinPartitions("part", "conv", "turn", "row", "line")

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, cuts in _whole_runs(batches):
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part, conv = int(frame["part"].iloc[a]), _plain(frame["conv"].iloc[a])
                if conv in cut.value.get(part, ()):
                    first = broken_first.value[conv] == part
                    m = sent.value.transfer(sent.value.emission(frame.iloc[a:b]), first)
                    yield pd.DataFrame({"part": [part], "conv": frame["conv"].iloc[a:a + 1].to_numpy(), "m": [m.ravel().tolist()]})

    broken_first = spark.sparkContext.broadcast({c: ps[0] for (_, c), ps in broken.items()})
    fixed: dict[tuple, tuple] = {}
    if broken:
        only = laid.where(F.col("part").isin(sorted({p for p, _ in broken})))
        by_conv: dict = {}
        for r in stored(only.mapInPandas(matrices, f"part int, conv {kind}, m array<double>"), "chat-ends").collect():
            by_conv.setdefault(r["conv"], {})[r["part"]] = np.array(r["m"]).reshape(STATES, STATES)
        for conv, ms in by_conv.items():
            order = sorted(ms)
            score, back = ms[order[0]][0], []
            for p in order[1:]:
                way = score[:, None] + ms[p]
                back.append(way.argmax(axis=0))
                score = way.max(axis=0)
            state = int(score.argmax())
            for k in range(len(order) - 1, -1, -1):
                before = int(back[k - 1][state]) if k else None
                fixed[order[k], conv] = (before, state)
                state = before
    known = spark.sparkContext.broadcast(fixed)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, cuts in _whole_runs(batches):
            emission = sent.value.emission(frame)
            state, began = np.empty(len(frame), np.int64), np.empty(len(frame), np.int64)
            parts, convs = frame["part"].to_numpy()[cuts[:-1]], frame["conv"].iloc[cuts[:-1]].tolist()
            for a, b, part, conv in zip(cuts[:-1], cuts[1:], parts, convs, strict=True):
                before, end = known.value.get((int(part), _plain(conv)), (None, None))
                state[a:b] = sent.value.decode(emission[a:b], before, end)
                begins = state[a:b] % 2 == 0
                if before is None:
                    begins[0] = True
                # The line that began the turn; -1: in an earlier partition.
                began[a:b] = np.maximum.accumulate(np.where(begins, np.arange(a, b), -1))
            out = frame[["conv", "part", "row", "line", "text", "turn"]].copy()
            out["role"] = state // 2
            out["first_row"] = np.where(began >= 0, frame["row"].to_numpy()[began], -1)
            out["first_line"] = np.where(began >= 0, frame["line"].to_numpy()[began], -1)
            yield out

    states = laid.mapInPandas(decode, f"conv {kind}, part int, row long, line int, text string, turn long, role int, "
                                      "first_row long, first_line int")
    states = stored(states, "chat-states")
    if broken:
        last = {(r["part"], r["conv"]): r["last"] for r in states.where(F.col("part").isin(sorted({p for p, _ in broken})))
                .where("first_row >= 0").groupBy("part", "conv").agg(F.max(F.struct("turn", "row", "line", "first_row", "first_line")).alias("last"))
                .collect() if (r["part"], r["conv"]) in broken}
        carried = []
        for (part, conv), parts in broken.items():
            earlier = [last[p, conv] for p in parts if p < part and (p, conv) in last]
            if earlier:
                carried.append((part, conv, earlier[-1]["first_row"], earlier[-1]["first_line"]))
        carry = spark.createDataFrame(carried, f"p int, c {kind}, r long, l int")
        states = states.join(F.broadcast(carry), (F.col("part") == F.col("p")) & F.col("conv").eqNullSafe(F.col("c"))
                             & (F.col("first_row") < 0), "left")
        states = states.withColumns({"first_line": F.coalesce("l", "first_line"), "first_row": F.coalesce("r", "first_row")})
    turns = states.groupBy("conv", "first_row", "first_line").agg(
        F.min(F.struct("turn", "row", "line", "role")).alias("first"), F.count("*").alias("n_lines"),
        F.sort_array(F.collect_list(F.struct("turn", "row", "line", "text"))).alias("all"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("first.role") + 1)
    text = F.trim(F.array_join(F.col("all.text"), "\n"), F.lit(" \n"))
    return turns.select("conv", F.col("first.turn").alias("turn"), F.col("first.line").alias("line"), role.alias("role"),
                        "n_lines", text.alias("text"),
                        F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n")).alias("rendered"))


def _plain(x):
    """A conversation id as the driver's dictionaries hold it."""
    return None if pd.isna(x) else x.item() if isinstance(x, np.generic) else x


def parse(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text",
          role: Column | None = None) -> DataFrame:
    """Parse transcripts; ``role`` (null where not to be used) labels the rows to learn from."""
    lines = lines_of(df, conv_col, turn_col, text_col, role)
    return parse_lines(lines, learn(lines)).withColumnRenamed("conv", conv_col)


def held_out(conv_id: Column) -> Column:
    return F.coalesce(F.crc32(conv_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def as_transcript(df: DataFrame, conv_col: str = "conv_id", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turn a table of labelled turns into raw pieces: each conversation gets one of seven notations by hash.

    Five spell the role in some way, one names the speakers (names by hash, which say nothing of the role), and one has no marker at all.
    """
    style = F.pmod(F.xxhash64(conv_col), F.lit(7))
    r = F.col(role_col)
    as_user = F.when(r == "user", "Human").when(r == "assistant", "AI").when(r == "system", "System")
    short = F.when(r == "user", "Q").when(r == "assistant", "A").when(r == "system", "System")
    letters = F.translate(F.substring(F.md5(F.concat_ws(":", F.col(conv_col).cast("string"), r)), 1, 6), "0123456789", "ghijklmnop")
    name = F.when(r.isNotNull(), F.initcap(letters))
    head = F.when(style == 0, F.concat(F.initcap(r), F.lit(": "))).when(style == 1, F.concat(as_user, F.lit(": "))) \
        .when(style == 2, F.concat(F.lit("### "), r, F.lit("\n"))).when(style == 3, F.concat(F.lit("<|"), r, F.lit("|>"))) \
        .when(style == 4, F.concat(short, F.lit(": "))).when(style == 5, F.concat(name, F.lit(": ")))
    return df.withColumn(text_col, F.concat(F.coalesce(head, F.lit("")), F.coalesce(F.col(text_col), F.lit(""))))
