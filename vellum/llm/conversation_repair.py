"""Conversation structure repair over a suffix-shared automaton of signatures.

A conversation should read ``(s?(ua)+)?`` in role initials: perhaps a system
turn, then user and assistant in turn.  Faulty rows are blank, duplicate or
truncated.  Edits: Keep 0, Rerole (to user or assistant, whichever the grammar
wants) 3, Delete 4 (blank and duplicate rows must go), Insert an empty user or
assistant row 3; a truncated row that stays costs 3 more.  Among the cheapest
edit strings the ASCII-least one is taken.

1. ``row_signs`` gives each row a sign: role initial (s, u, a, or x for any
   other; upper case if truncated) or ``d`` if it must go.  ``signatures`` joins
   a conversation's signs; only keys and digests are shuffled for this, not texts.
2. ``cheapest_repairs`` takes each distinct signature of all conversations once, sorts them
   by their reversed text over range partitions and walks them in that order:
   a task holds the automaton's path for the suffixes of the signature
   before, keeps the nodes of the common suffix, and builds the rest.  A node
   has, for each grammar state, the cost to go and the first edits of the best
   audit suffix, whose remainder is the next node's; so each suffix is worked
   out once, and once more for a path that a partition border cuts.  Nodes
   whose costs differ by a constant only behave alike for whatever stands
   before them: their sign is looked up in one minimised table.
3. ``follow`` streams texts in order, behind a header row with the audit, and applies it.

From a state, different edits before and at a row never begin alike (``I``s, then
one of D, K, R), so the ASCII-least audit is the least first edits among the
cheapest ones, node by node.

One conversation gives one audit and one SHA-256 over its whole text, so its
rows meet in one task; they are sorted by Spark (which spills) and streamed:
a task holds one row's text and one audit (a letter a row), never a whole
conversation's texts.

Defined results: a null role or text is one space, a null turn sorts first,
rows of null conversation id are one conversation; rows of one turn are ordered by
role, then by the SHA-256 of their text; a repeated row is a duplicate; a
conversation without rows left has zeros and empty strings; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import materialise, prepare, read_table

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3      # costs
#: Grammar states: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
READS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: What an inserted or reroled row becomes in a state, and the state after it.
WANTS = [("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER)]
#: Inserts that end a conversation from each state.
END_INSERTS = [0, 2, 1, 0]
BLOCK = 4096                    # rows whose signs are joined at a time


# --- signs and signatures (DataFrame functions) ---------------------------

def tidy(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    space = F.lit(" ")
    return turns.select(F.col(conv).alias("_c"), F.col(turn).alias("_t"), F.coalesce(F.col(role), space).alias("_r"),
                        F.coalesce(F.col(text), space).alias("_x"))


def row_signs(rows: DataFrame) -> DataFrame:
    """Of ``tidy`` rows with a flag ``_gone`` (rows that only name their conversation):
    per row ``_c, _gone, _t, _n`` (place), ``_fault, _sign, _bad`` (illegal after the row
    before it), ``_new_turn``."""
    initial = F.substring("_r", 1, 1)
    last = F.substring(F.rtrim(F.col("_x"), F.lit(SPACE)), -1, 1)
    keys = rows.select("_c", "_gone", "_t", "_r", F.unhex(F.sha2(F.col("_x").cast("binary"), 256)).alias("_d"),
                       initial.alias("_i"), (~F.col("_x").rlike(r"[^\x20\x09-\x0D]")).alias("_blank"),
                       (~last.isin(".", "!", "?")).alias("_cut")).repartition("_c")
    own = Window.partitionBy("_c", "_gone").orderBy(F.col("_t").asc_nulls_first(), "_r", "_d")
    keys = (keys.withColumn("_n", F.row_number().over(own)).withColumn("_before", F.lag("_i").over(own))
            .withColumn("_turn_before", F.lag("_t").over(own)))
    first = F.min("_n").over(Window.partitionBy("_c", "_gone", "_r", "_d"))
    fault = (F.when(F.col("_blank"), "blank").when(F.col("_n") > F.col("_first"), "duplicate").when(F.col("_cut"), "truncated"))
    kind = F.when(F.col("_i").isin("s", "u", "a"), F.col("_i")).otherwise(F.lit("x"))
    sign = (F.when(F.col("_fault").isin("blank", "duplicate"), F.lit("d"))
            .when(F.col("_fault") == "truncated", F.upper(kind)).otherwise(kind))
    bad = F.col("_before").isNotNull() & ~F.concat("_before", "_i").isin("su", "ua", "au")
    new_turn = F.col("_t").isNotNull() & (F.col("_turn_before").isNull() | (F.col("_turn_before") != F.col("_t")))
    return (keys.withColumn("_first", first).withColumn("_fault", fault)
            .select("_c", "_gone", "_t", "_n", "_fault", sign.alias("_sign"), bad.alias("_bad"), new_turn.alias("_new_turn")))


def signatures(signs: DataFrame) -> DataFrame:
    """One row per conversation: counts and ``signature``."""
    live = ~F.col("_gone")
    number = lambda cond: F.sum((live & F.coalesce(cond, F.lit(False))).cast("bigint"))
    faults = ("blank", "duplicate", "truncated")
    blocks = signs.withColumn("_block", F.floor((F.col("_n") - 1) / BLOCK)).groupBy("_c", "_block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(live, F.struct("_n", "_sign")))), lambda s: s["_sign"]), "").alias("_signs"),
        F.max(F.when(live, F.col("_t"))).alias("_high"), F.min(F.when(live, F.col("_t"))).alias("_low"),
        number(F.col("_new_turn")).alias("_turns"), number(F.col("_bad")).alias("illegal"),
        *[number(F.col("_fault") == f).alias(f) for f in faults])
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_signs"))), lambda s: s["_signs"]), "")
    gaps = F.max("_high") - F.min("_low") + 1 - F.sum("_turns")
    return blocks.groupBy("_c").agg(F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
                                    *[F.sum(c).alias(c) for c in (*faults, "illegal")], joined.alias("signature"))


# --- the automaton --------------------------------------------------------

class SuffixAutomaton:
    """Costs to go, node by node from the end of signatures.

    A node is ``(choices, costs, base)``: per grammar state the first edits and the state
    after them, and the cost to go as ``base`` plus the entry of ``costs``.
    ``choices`` and ``costs`` come from the minimised table, so they are worked
    out once per (sign, behaviour of what follows).
    """

    def __init__(self):
        costs = tuple(INSERT * k for k in END_INSERTS)
        self.end = (None, costs, 0)
        self.table: dict[tuple[str, tuple], tuple] = {}

    def before(self, sign: str, node: tuple) -> tuple:
        """The node of ``sign`` followed by the suffix of ``node``."""
        _, costs, base = node
        known = self.table.get((sign, costs))
        if known is None:
            known = self.table[sign, costs] = self._work_out(sign, costs)
        choices, relative, more = known
        return choices, relative, base + more

    @staticmethod
    def _work_out(sign: str, costs: tuple) -> tuple:
        best = []
        for state in range(4):
            options, inserts, at = [], 0, state
            while inserts < 3:                       # two inserts reach every state there is to reach
                paid, edits = INSERT * inserts, "I" * inserts
                options.append((paid + DELETE + costs[at], edits + "D", at))
                if sign != "d":
                    stays = paid + (CUT_OFF if sign.isupper() else 0)
                    kept = READS.get((at, sign.lower()))
                    if kept is not None:
                        options.append((stays + KEEP + costs[kept], edits + "K", kept))
                    options.append((stays + REROLE + costs[WANTS[at][1]], edits + "R", WANTS[at][1]))
                inserts, at = inserts + 1, WANTS[at][1]
            best.append(min(options))
        least = min(b[0] for b in best)
        return tuple((e, q) for _, e, q in best), tuple(c - least for c, _, _ in best), least


class SignatureWalk:
    """Signatures in the order of their reversed text, on one path of the automaton."""

    def __init__(self):
        self.automaton = SuffixAutomaton()
        self.path, self.reversed = [self.automaton.end], ""

    def repair(self, signature: str) -> tuple[int, str, int]:
        """(cost, audit, nodes built for it)."""
        turned = signature[::-1]
        shared = len(commonprefix([turned, self.reversed]))
        del self.path[shared + 1:]
        for sign in turned[shared:]:
            self.path.append(self.automaton.before(sign, self.path[-1]))
        self.reversed = turned
        _, costs, base = self.path[-1]
        state, edits = START, []
        for choices, _, _ in reversed(self.path[1:]):
            first, state = choices[state]
            edits.append(first)
        edits.append("I" * END_INSERTS[state])
        return base + costs[START], "".join(edits), len(turned) - shared


def cheapest_repairs(distinct: DataFrame) -> DataFrame:
    """``signature, cost, audit, new_nodes`` for a table of distinct signatures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = SignatureWalk()
        for rb in batches:
            found = [walk.repair(s) for s in rb.column(0).to_pylist()]
            if found:
                cost, audit, nodes = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(cost, pa.int64()), pa.array(audit, pa.string()),
                                                  pa.array(nodes, pa.int64())], names=["signature", "cost", "audit", "new_nodes"])

    turned = F.reverse("signature")
    ordered = distinct.select("signature").repartitionByRange(turned).sortWithinPartitions(turned)
    return ordered.mapInArrow(run, "signature string, cost long, audit string, new_nodes long")


# --- applying the audits --------------------------------------------------

def follow(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows, as ``rows`` come."""
    state, at = START, 0

    def inserted():
        nonlocal state, at
        while audit[at:at + 1] == "I":
            role, state = WANTS[state]
            at += 1
            yield role, ""

    for role, text in rows:
        yield from inserted()
        edit, at = audit[at], at + 1
        if edit == "R":
            role, state = WANTS[state]
        elif edit == "K":
            state = READS[state, role[:1]]
        if edit != "D":
            yield role, text
    yield from inserted()


def _in_order(turns: DataFrame, headers: DataFrame) -> DataFrame:
    """Headers ``(_c, _head, ...)`` and text rows: each conversation's header, then its rows in order."""
    rows = turns.select("_c", "_t", "_r", "_x")
    both = headers.withColumn("_kind", F.lit(0)).unionByName(rows.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    digest = F.when(F.col("_kind") == 1, F.unhex(F.sha2(F.col("_x").cast("binary"), 256)))
    both = both.withColumn("_d", digest).repartition("_c")
    return both.sortWithinPartitions(F.col("_c"), "_kind", F.col("_t").asc_nulls_first(), "_r", "_d")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Iterator]]:
    """(batch, place of the header in it, iterator of (role, text)) per conversation, streamed."""
    def places():
        for rb in batches:
            kinds, roles, texts = (rb.column(rb.schema.get_field_index(c)) for c in ("_kind", "_r", "_x"))
            for k, kind in enumerate(kinds.to_pylist()):
                yield rb, k, kind, roles, texts

    stream = places()
    ahead = next(stream, None)

    def own():
        nonlocal ahead
        while (ahead := next(stream, None)) is not None and ahead[2] == 1:
            yield ahead[3][ahead[1]].as_py(), ahead[4][ahead[1]].as_py()

    while ahead is not None:
        rb, k = ahead[0], ahead[1]
        rows = own()
        yield rb, k, rows
        for _ in rows:              # whatever the caller left
            pass


def _gathered(rows: Iterator[pa.RecordBatch], most: int = 1024, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows that come one by one, as larger batches."""
    held, held_bytes = [], 0
    for rb in rows:
        held.append(rb)
        held_bytes += rb.nbytes
        if len(held) >= most or held_bytes > size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, held_bytes = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def repaired_digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``audits`` (``_c``, ``audit`` and more) with ``repaired_sha256`` of ``role:text``, line by line."""
    ordered, names = _in_order(turns, audits), audits.columns

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, k, rows in _conversations(batches):
            audit = rb.column(rb.schema.get_field_index("audit"))[k].as_py()
            digest, first = hashlib.sha256(), True
            for role, text in follow(audit, rows):
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
            row = rb.slice(k, 1)
            yield pa.RecordBatch.from_arrays([*(row.column(row.schema.get_field_index(n)) for n in names),
                                              pa.array([digest.hexdigest()], pa.string())], names=[*names, "repaired_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(told(batches))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in audits.schema.fields)
    return ordered.mapInArrow(run, f"{fields}, repaired_sha256 string")


def repaired_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations' rows: ``_c, seq`` (from 0), ``role, text``."""
    ordered = _in_order(turns, audits.select("_c", "audit"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, k, rows in _conversations(batches):
            audit = rb.column(rb.schema.get_field_index("audit"))[k].as_py()
            conv = rb.column(rb.schema.get_field_index("_c")).slice(k, 1)
            for n, (role, text) in enumerate(follow(audit, rows)):
                yield pa.RecordBatch.from_arrays([conv, pa.array([n], pa.int64()), pa.array([role], pa.string()),
                                                  pa.array([text], pa.string())], names=["_c", "seq", "role", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(told(batches))

    return ordered.mapInArrow(run, f"_c {dict(turns.dtypes)['_c']}, seq long, role string, text string")


def audits_of(rows: DataFrame) -> DataFrame:
    """Counts, ``cost`` and ``audit`` per conversation of ``tidy`` rows with ``_gone``."""
    told = materialise(signatures(row_signs(rows)))
    answers = materialise(cheapest_repairs(told.select("signature").distinct()))
    return told.join(answers.select("signature", "cost", "audit"), "signature")


def repair(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(counts, cost and audit per conversation; the repaired rows)."""
    rows = tidy(turns, conv, turn, role, text).withColumn("_gone", F.lit(False))
    audits = materialise(audits_of(rows))
    return (audits.drop("signature").withColumnRenamed("_c", conv),
            repaired_turns(rows, audits).withColumnRenamed("_c", conv))


# --- the query ------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage to ``tidy`` rows; dropped rows stay as ``_gone``."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("_h", F.crc32(F.concat(name("_c"), F.lit(":"), name("_t")).cast("binary")) % 20)
    text = F.when(F.col("_h") == 1, F.lit("")).when(F.col("_h") == 2, F.translate("_x", ".!?", "")).otherwise(F.col("_x"))
    role = F.when(F.col("_h") == 4, F.lit("user")).otherwise(F.col("_r"))
    times = F.when(F.col("_h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.select("_c", "_t", role.alias("_r"), text.alias("_x"), (F.col("_h") == 0).alias("_gone"), F.explode(times).alias("_copy"))
            .drop("_copy"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = damaged(tidy(read_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text"))
    audits = audits_of(rows).drop("signature")
    out = repaired_digests(rows.where(~F.col("_gone")), audits)
    return out.withColumnRenamed("_c", "conv_id").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


#: The same by another way: forward, row by row of each conversation, the cheapest edits into each state.
ORACLE_SQL = r"""
WITH RECURSIVE
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS x,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(unicode(k[i]) AS BIGINT)),
    lambda c, b: list_reduce(range(0, 8), lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(c, b)),
    4294967295::BIGINT), 4294967295) % 20 AS h FROM src),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE r END AS r,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS x,
         unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hashed WHERE h <> 0),
placed AS (
  SELECT *, CAST(row_number() OVER w AS INTEGER) AS n, lag(r[1]) OVER w AS before, turn IS NOT NULL AND turn IS DISTINCT FROM lag(turn) OVER w AS new_turn
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, sha256(x), copy)),
marked AS (
  SELECT *, regexp_extract(x, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last,
         n > min(n) OVER (PARTITION BY conv_id, r, x) AS again FROM placed),
faulty AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM marked),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(*) FILTER (WHERE new_turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || r[1] NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows
  FROM faulty GROUP BY conv_id),
-- states: 0 nothing yet, 1 after s, 2 after u, 3 after a
inserts(state, here, letters, added) AS (VALUES
  (0, 0, '', []::VARCHAR[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []),
  (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:']),
  (0, 3, 'II', ['user:', 'assistant:']), (1, 3, 'II', ['user:', 'assistant:']), (2, 2, 'II', ['assistant:', 'user:']), (3, 3, 'II', ['user:', 'assistant:'])),
edits(here, initial, letter, goal, role) AS (VALUES
  (0, 's', 'K', 1, NULL), (0, 'u', 'K', 2, NULL), (1, 'u', 'K', 2, NULL), (2, 'a', 'K', 3, NULL), (3, 'u', 'K', 2, NULL),
  (0, NULL, 'R', 2, 'user'), (1, NULL, 'R', 2, 'user'), (2, NULL, 'R', 3, 'assistant'), (3, NULL, 'R', 2, 'user'),
  (0, NULL, 'D', 0, NULL), (1, NULL, 'D', 1, NULL), (2, NULL, 'D', 2, NULL), (3, NULL, 'D', 3, NULL)),
steps AS (
  SELECT f.conv_id, f.n, i.state, e.goal, 3 * length(i.letters) + CASE letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
           + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 3 ELSE 0 END AS cost,
         i.letters || e.letter AS audit,
         list_concat(i.added, CASE WHEN letter = 'D' THEN [] ELSE [coalesce(e.role, f.r) || ':' || f.x] END) AS told
  FROM faulty f, inserts i JOIN edits e ON i.here = e.here
  WHERE (letter = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (letter <> 'K' OR initial = f.r[1])),
best AS (
  SELECT conv_id, 0 AS n, 0 AS state, {'cost': 0, 'audit': '', 'told': []::VARCHAR[]} AS b FROM counted
  UNION ALL
  SELECT b.conv_id, s.n, s.goal AS state, min({'cost': b.b.cost + s.cost, 'audit': b.b.audit || s.audit, 'told': list_concat(b.b.told, s.told)}) AS b
  FROM best b JOIN steps s ON b.conv_id IS NOT DISTINCT FROM s.conv_id AND s.n = b.n + 1 AND s.state = b.state
  GROUP BY b.conv_id, s.n, s.goal),
ended AS (
  SELECT c.conv_id, min({'cost': b.b.cost + 3 * length(e.letters), 'audit': b.b.audit || e.letters, 'told': list_concat(b.b.told, e.added)}) AS b
  FROM best b JOIN counted c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.n = c.n_rows
  JOIN inserts e ON e.state = b.state AND e.here IN (0, 3) GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
       coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.told, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""
