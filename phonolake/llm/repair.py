"""Conversation structure repair by generalised LR parsing of the turns' roles.

A conversation is well formed if its roles are nothing, or at most one system turn and then pairs of user and assistant. The
LR automaton of that grammar is built from ``GRAMMAR``. A parse runs over the turns with a graph-structured stack: besides
keeping a turn, it may delete it, give it the role that is wanted, or insert a turn without text; blank turns and repeated
ones must go. Every edge of the stack carries the (cost, edits) of the turns it spans; edges between equal nodes merge to the
smaller, so stacks that agree in their tops share all work. Edits that cost the same over the same turns are never prefixes
of each other (what is longer has more inserts), so the smaller prefix stays the smaller one and the minimum is exact.

The grammar is left-recursive, so only eight stacks can be on the graph between two turns. That lets a long conversation be
cut: turns are numbered over the whole table by a range sort, blocks of ``BLOCK`` turns are summed up by what each stack
becomes at which (cost, edits), and only these summaries go through the conversation in order. Then blocks get their
edits and are changed apart from each other. No conversation's texts are held in one task; a digest over a whole
conversation reads them as a stream, and it is the one value per conversation that has to.

Defined results: null roles and texts are one space; turns go by number, null first, equal numbers by role and text digest; a
null conversation is a conversation; rows that are equal in all of that are repeated turns, of which one may stay; very long
texts move whole and are never parsed; an empty table gives an empty one. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonolake.llm.registry import bound_batches, query, table
from phonolake.operators.ordered import index_rows, join_on

#: Productions by role initials: a conversation, its body, a pair.
GRAMMAR = [("Z", ""), ("Z", "B"), ("Z", "sB"), ("B", "BP"), ("B", "P"), ("P", "ua")]
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: From any stack, the rest of a conversation costs at most this more than from any other: one may have to insert the missing
#: assistant, and to delete a system turn that the other can still keep.
SLACK = DELETE + INSERT
BLOCK = 64
BLANKS = " \t\n\x0b\x0c\r"
ENDS = [".", "!", "?"]
FAULTS = ["clean", "truncated", "blank", "duplicate"]
LEGAL = {"su", "ua", "au"}

Weight = tuple[int, str]
Stack = tuple[int, ...]


def automaton(grammar: list[tuple[str, str]]) -> tuple[list[dict[str, int]], dict[int, tuple[str, int]], set[int]]:
    """Moves of the LR(0) automaton, the production each complete state reduces by, and the states that accept."""
    heads = {head for head, _ in grammar}

    def close(items: set) -> frozenset:
        items, waiting = set(items), list(items)
        while waiting:
            rule, dot = waiting.pop()
            ahead = grammar[rule][1][dot : dot + 1]
            new = {(i, 0) for i, (head, _) in enumerate(grammar) if head == ahead and ahead in heads} - items
            items |= new
            waiting += new
        return frozenset(items)

    start = grammar[0][0]
    states = [close({(i, 0) for i, (head, _) in enumerate(grammar) if head == start})]
    moves, reduces, accepts = [], {}, set()
    for number, state in enumerate(states):  # grows while it is read
        moves.append({})
        for rule, dot in sorted(state):
            head, body = grammar[rule]
            if dot < len(body):
                to = close({(r, d + 1) for r, d in state if grammar[r][1][d : d + 1] == body[dot]})
                if to not in states:
                    states.append(to)
                moves[number][body[dot]] = states.index(to)
            elif head == start:
                accepts.add(number)
            else:
                reduces[number] = (head, len(body))
    return moves, reduces, accepts


MOVES, REDUCES, ACCEPTS = automaton(GRAMMAR)


class Node:
    """A stack top: its state, and the nodes below with the weight of what lies between."""

    __slots__ = ("state", "below")

    def __init__(self, state: int) -> None:
        self.state = state
        self.below: dict[Node | None, Weight] = {}

    def paths(self, size: int) -> Iterator[tuple[Node, Weight]]:
        if not size:
            yield self, (0, "")
            return
        for node, (cost, audit) in list(self.below.items()):
            for base, (before, edits) in node.paths(size - 1):
                yield base, (before + cost, edits + audit)

    def stacks(self) -> Iterator[tuple[Stack, Weight]]:
        for node, (cost, audit) in self.below.items():
            if node is None:
                yield (self.state,), (cost, audit)
            else:
                for stack, (before, edits) in node.stacks():
                    yield (*stack, self.state), (before + cost, edits + audit)


def _link(layer: dict[int, Node], state: int, below: Node | None, weight: Weight) -> bool:
    node = layer.setdefault(state, Node(state))
    if below in node.below and node.below[below] <= weight:
        return False
    node.below[below] = weight
    return True


def _settle(layer: dict[int, Node]) -> None:
    """Reduce and insert until nothing gets cheaper, then drop the tops that were reduced."""
    changed = True
    while changed:
        changed = False
        for node in list(layer.values()):
            if node.state in REDUCES:
                head, size = REDUCES[node.state]
                for base, weight in node.paths(size):
                    changed |= _link(layer, MOVES[base.state][head], base, weight)
            else:
                for role in ROLES:
                    if role in MOVES[node.state]:
                        changed |= _link(layer, MOVES[node.state][role], node, (INSERT, "I"))
    for state in [s for s in layer if s in REDUCES]:
        del layer[state]


def symbol(initial: str, fault: int) -> str:
    """One character for a turn: its role's initial, ``?`` if it is none of the grammar's, and its fault."""
    return chr(65 + 4 * "?sua".index(initial) + fault)


def meaning(letter: str) -> tuple[str, int]:
    kind, fault = divmod(ord(letter) - 65, 4)
    return "?sua"[kind], fault


@functools.lru_cache(maxsize=1 << 14)
def summary(turns: str, entry: Stack) -> dict[Stack, Weight]:
    """What the stack ``entry`` can become over ``turns``, each at its smallest (cost, edits)."""
    below, layer = None, {}
    for state in entry:
        layer = {}
        _link(layer, state, below, (0, ""))
        below = layer[state]
    _settle(layer)
    for letter in turns:
        initial, fault = meaning(letter)
        after: dict[int, Node] = {}
        for node in layer.values():
            for under, (cost, audit) in node.below.items():
                _link(after, node.state, under, (cost + DELETE, audit + "D"))
            if fault > 1:
                continue
            own = CUT_OFF * fault
            for role, price, edit in ((initial, 0, "K"), *((r, REROLE, "R") for r in ROLES if r != initial)):
                if role in MOVES[node.state]:
                    _link(after, MOVES[node.state][role], node, (price + own, edit))
        _settle(after)
        layer = after
    found: dict[Stack, Weight] = {}
    for node in layer.values():
        for stack, weight in node.stacks():
            found[stack] = min(weight, found.get(stack, weight))
    return found


class Reading:
    """One way to read a conversation up to a block's end: the stack, the cost, the block's edits, and what was before."""

    __slots__ = ("stack", "cost", "audit", "before")

    def __init__(self, stack: Stack, cost: int, audit: str, before: Reading | None) -> None:
        self.stack, self.cost, self.audit, self.before = stack, cost, audit, before

    def edits(self) -> str:
        parts, at = [], self
        while at is not None:
            parts.append(at.audit)
            at = at.before
        return "".join(reversed(parts))


class Chain:
    """Readings of one conversation, block by block, but for those too dear to win.

    Blocks whose edits all readings share are handed out.
    """

    PATIENCE = 8

    def __init__(self) -> None:
        self.tops = [Reading((0,), 0, "", None)]
        self.waiting = 0

    def push(self, turns: str) -> list[tuple[str, str, int]]:
        best: dict[Stack, Reading] = {}
        for top in self.tops:
            for stack, (cost, audit) in summary(turns, top.stack).items():
                new = Reading(stack, top.cost + cost, audit, top)
                old = best.get(stack)
                if old is None or (new.cost, new.edits()) < (old.cost, old.edits()):
                    best[stack] = new
        least = min(t.cost for t in best.values())
        self.tops = [t for t in best.values() if t.cost <= least + SLACK]
        self.waiting += 1
        return self._shared() if self.waiting % self.PATIENCE == 0 else []

    def _shared(self) -> list[tuple[str, str, int]]:
        level = {id(t): t for t in self.tops}
        depth = self.waiting
        while len(level) > 1 and depth:
            level = {id(t.before): t.before for t in level.values()}
            depth -= 1
        return self._hand_out(next(iter(level.values())), depth) if depth else []

    def _hand_out(self, last: Reading, blocks: int) -> list[tuple[str, str, int]]:
        out, at = [], last
        for _ in range(blocks):
            before = at.before
            wanted = "u" if "u" in MOVES[before.stack[-1]] else "a"
            out.append((at.audit, wanted, at.cost - before.cost))
            at = before
        last.before, last.audit = None, ""
        self.waiting -= blocks
        return out[::-1]

    def end(self) -> list[tuple[str, str, int]]:
        whole = [t for t in self.tops if t.stack[-1] in ACCEPTS]
        return self._hand_out(min(whole, key=lambda t: (t.cost, t.edits())), self.waiting)


def place(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns as (conv, turn, role, text, key, place): digest of role and text, place in the table's order. They are written."""
    spoken, said = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role, text))
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), spoken.alias("role"), said.alias("text")
    )
    # Equal rows differ by their number, so that a range sort can part them.
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.withColumns({"key": F.unhex(F.sha2(whole.cast("binary"), 256)), "copy": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "key", "copy")]
    return index_rows(rows, order, "place")[0].drop("copy")


def diagnose(rows: DataFrame) -> DataFrame:
    """Placed turns as (conv, place, role, fault), the number of the fault; texts are only looked at where they are."""
    rest = F.rtrim("text", F.lit(BLANKS))
    own = F.when(rest == "", 2).when(~F.substring(rest, -1, 1).isin(ENDS), 1).otherwise(0)
    narrow = rows.select("conv", "place", "role", own.alias("own"))
    # Places are unique, so the first places meet their rows without any hot key.
    firsts = rows.groupBy("conv", "key").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    met = narrow.join(firsts, "place", "left")
    fault = F.when((F.col("own") != 2) & F.col("first").isNull(), 3).otherwise(F.col("own"))
    return met.select("conv", "place", "role", fault.alias("fault"))


def _by_conversation(blocks: DataFrame) -> DataFrame:
    """Blocks of a conversation in order, in as many tasks as a shuffle has: rows are few, their parsing is not."""
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(tasks, "conv").sortWithinPartitions("conv", "block")


def _block() -> Column:
    return F.floor(F.col("place") / BLOCK).alias("block")


EDITS = "block long, audit string, wanted string, cost long, blank long, duplicate long, truncated long, illegal long"


def _edits(batches):
    """Summaries of blocks in the order of their conversations; what is held of one is what readings do not share."""
    kind, now, chain, last = None, None, None, ""
    held: list[tuple] = []

    def give(edits: list[tuple]) -> list[tuple]:
        out = [(now, held[i][0], *e, *held[i][1:]) for i, e in enumerate(edits)]
        del held[: len(edits)]
        return out

    names = ["conv", "block", "audit", "wanted", "cost", "blank", "duplicate", "truncated", "illegal"]
    for batch in batches:
        kind, out = batch.schema.field("conv").type, []
        for conv, block, turns in zip(*(batch[c].to_pylist() for c in ("conv", "block", "turns")), strict=True):
            if chain is None or conv != now:
                out += give(chain.end()) if chain else []
                now, chain, last = conv, Chain(), ""
            turns = "".join(turns)
            faults = [meaning(t)[1] for t in turns]
            roles = last + "".join(meaning(t)[0] for t in turns)
            illegal = sum(roles[i : i + 2] not in LEGAL for i in range(len(roles) - 1))
            held.append((block, faults.count(2), faults.count(3), faults.count(1), illegal))
            last = roles[-1]
            out += give(chain.push(turns))
        if out:
            yield _rows(out, names, kind)
    if chain is not None:
        yield _rows(give(chain.end()), names, kind)


def _rows(rows: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [kind, *(pa.string() if isinstance(c[0], str) else pa.int64() for c in columns[1:])]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def plan_edits(rows: DataFrame) -> DataFrame:
    """Edits of each block of diagnosed turns, the role wanted at its start, its cost and its faults."""
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 4).when(initial == "u", 8).when(initial == "a", 12).otherwise(0)
    letter = F.char(F.lit(65) + kind + F.col("fault"))
    listed = F.array_sort(F.collect_list(F.struct("place", letter.alias("letter"))))
    blocks = rows.groupBy("conv", _block()).agg(F.transform(listed, lambda t: t["letter"]).alias("turns"))
    blocks = _by_conversation(blocks)
    conv = rows.schema["conv"].dataType.simpleString()
    return blocks.mapInArrow(_edits, f"conv {conv}, {EDITS}")


def edited(turns: list[dict], audit: str, wanted: str) -> list[tuple[str, str]]:
    """Turns of a block after its edits; ``wanted`` is the initial that the grammar asks for at its start."""
    out, left = [], iter(turns)
    for edit in audit:
        if edit == "I":
            role, text = ROLES[wanted], ""
        else:
            turn = next(left)
            role, text = turn["role"], turn["text"]
            if edit == "D":
                continue
            role = ROLES[wanted] if edit == "R" else role
        out.append((role, text))
        wanted = "a" if role[:1] == "u" else "u"
    return out


REPAIRED = "array<struct<role:string,text:string>>"
_REPAIRED = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def repair(rows: DataFrame) -> DataFrame:
    """Repaired turns of each block of placed turns: conv, block, turns, and the columns of ``plan_edits``."""

    def changed(turns: pa.Array, audit: pa.Array, wanted: pa.Array) -> pa.Array:
        each = zip(turns.to_pylist(), audit.to_pylist(), wanted.to_pylist(), strict=True)
        done = [[{"role": r, "text": t} for r, t in edited(*block)] for block in each]
        return pa.array(done, _REPAIRED)

    changed = F.arrow_udf(changed, REPAIRED)
    listed = F.array_sort(F.collect_list(F.struct("place", "role", "text")))
    blocks = rows.groupBy("conv", _block()).agg(F.transform(listed, lambda t: F.struct(t["role"], t["text"])).alias("turns"))
    edits = plan_edits(diagnose(rows)).withColumnsRenamed({"conv": "_conv", "block": "_block"})
    met = blocks.join(edits, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    return met.drop("_conv", "_block").withColumn("turns", changed("turns", "audit", "wanted"))


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """One row per turn: conv, block, place in the block, role, text."""
    return repaired.select("conv", "block", F.posexplode("turns").alias("place", "turn")).select(
        "conv", "block", "place", "turn.role", "turn.text"
    )


SUMS = ["blank", "duplicate", "truncated", "illegal", "cost"]
DIGEST = ", ".join(f"{c} long" for c in SUMS) + ", audit string, repaired_sha256 string"


def _digest(batches):
    """Counts, edits and hash of each conversation, from its blocks in order; lines are hashed as they come."""
    kind, now, seen = None, None, False
    names = ["conv", *SUMS, "audit", "repaired_sha256"]

    def done() -> tuple:
        return (now, *sums, "".join(audit), sha.hexdigest())

    for batch in batches:
        kind, out = batch.schema.field("conv").type, []
        columns = [batch[c].to_pylist() for c in ("conv", *SUMS, "audit", "n", "lines")]
        for conv, *row in zip(*columns, strict=True):
            if not seen or conv != now:
                if seen:
                    out.append(done())
                now, seen, sums, audit, sha, started = conv, True, [0] * len(SUMS), [], hashlib.sha256(), False
            sums = [a + b for a, b in zip(sums, row, strict=False)]
            edits, n, lines = row[len(SUMS) :]
            audit.append(edits)
            if n:
                sha.update((("\n" if started else "") + lines).encode())
                started = True
        if out:
            yield _rows(out, names, kind)
    if seen:
        yield _rows([done()], names, kind)


def digest(repaired: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, edits, and the hash of its repaired ``role:text`` lines."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    blocks = repaired.select("conv", "block", *SUMS, "audit", F.size("turns").alias("n"), lines.alias("lines"))
    blocks = _by_conversation(blocks)
    conv = repaired.schema["conv"].dataType.simpleString()
    return blocks.mapInArrow(_digest, f"conv {conv}, {DIGEST}")


def _damaged(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns with planted faults, and each conversation's missing numbers after that."""
    or_blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat_ws(":", or_blank("conv_id"), or_blank("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", or_blank("role").alias("role"), or_blank("text").alias("text"), draw.alias("draw"))
    left = F.when(F.col("draw") != 0, F.col("turn"))
    spread = F.max(left) - F.min(left) + 1 - F.count_distinct(left)
    gaps = rows.groupBy("conv_id").agg(F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("draw") == 3, 2).otherwise(1)
    rows = rows.where("draw != 0").withColumn("time", F.explode(F.array_repeat(F.lit(0), times)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text")), gaps


OP13_SQL = r"""
with recursive r0 as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
  list_reduce(list_concat([4294967295::bigint], flatten(list_transform(
      string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
      lambda c: [ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))) crc from conversations),
r1 as (select conv_id, turn, role, text, xor(crc, 4294967295) % 20 draw from r0),
r2 as (select conv_id, turn, case when draw = 4 then 'user' else role end as role,
  case when draw = 1 then '' when draw = 2 then translate(text, '.!?', '') else text end as text,
  unnest(range(case when draw = 3 then 2 else 1 end)) copy from r1 where draw <> 0),
r3 as (select *, row_number() over (partition by conv_id order by turn nulls first, role,
    sha256(length(role)::varchar || ':' || role || text), copy) i,
  rtrim(text, e' \t\n\x0b\x0c\r') rest from r2),
r4 as (select *, row_number() over (partition by conv_id, role, text order by i) nth,
  lag(left(role, 1)) over (partition by conv_id order by i) prior, left(role, 1) k from r3),
r5 as (select conv_id, i, role, text, k, case when rest = '' then 2 when nth > 1 then 3
    when right(rest, 1) not in ('.', '!', '?') then 1 else 0 end fault,
  (prior is not null and prior || k not in ('su', 'ua', 'au'))::int illegal from r4),
-- Cheapest way to each state of the grammar: 0 nothing yet, 1 system, 2 user, 3 assistant last; c cost, e edits, t text.
seed as (select conv_id, max(i) n from r5 group by all),
dp(conv_id, n, i, s) as (
  select conv_id, n, 0::bigint, [{'q': 0, 'c': 0, 'e': '', 't': []::varchar[]},
    {'q': 2, 'c': 2, 'e': 'I', 't': ['user:']}, {'q': 3, 'c': 4, 'e': 'II', 't': ['user:', 'assistant:']}] from seed
  union all
  select conv_id, n, i, list({'q': q, 'c': b.c, 'e': b.e, 't': b.t}) from (
    select conv_id, n, i, z.q q, min({'c': z.c, 'e': z.e, 't': z.t}) b from (
      select conv_id, n, i, unnest(list_concat([w], list_concat(
          case when w.q in (0, 1, 3) then [{'q': 2, 'c': w.c + 2, 'e': w.e || 'I', 't': list_append(w.t, 'user:')},
            {'q': 3, 'c': w.c + 4, 'e': w.e || 'II', 't': list_concat(w.t, ['user:', 'assistant:'])}] else [] end,
          case when w.q = 2 then [{'q': 3, 'c': w.c + 2, 'e': w.e || 'I', 't': list_append(w.t, 'assistant:')},
            {'q': 2, 'c': w.c + 4, 'e': w.e || 'II', 't': list_concat(w.t, ['assistant:', 'user:'])}] else [] end))) z
      from (
        select conv_id, n, i, unnest(list_concat([{'q': v.q, 'c': v.c + 3, 'e': v.e || 'D', 't': v.t}],
          case when fault > 1 then [] else list_concat(
            case when (k = 's' and v.q = 0) or (k = 'u' and v.q <> 2) or (k = 'a' and v.q = 2) then
              [{'q': case k when 's' then 1 when 'u' then 2 else 3 end, 'c': v.c + fault, 'e': v.e || 'K',
                't': list_append(v.t, role || ':' || text)}] else [] end,
            case when k <> 'u' and v.q <> 2 then [{'q': 2, 'c': v.c + 2 + fault, 'e': v.e || 'R',
                't': list_append(v.t, 'user:' || text)}]
              when k <> 'a' and v.q = 2 then [{'q': 3, 'c': v.c + 2 + fault, 'e': v.e || 'R',
                't': list_append(v.t, 'assistant:' || text)}] else [] end) end)) w
        from (
          select dp.conv_id, dp.n, r5.i, r5.role, r5.text, r5.k, r5.fault, unnest(dp.s) v
          from dp join r5 on r5.conv_id is not distinct from dp.conv_id and r5.i = dp.i + 1)))
    group by conv_id, n, i, z.q) group by conv_id, n, i),
fin as (select conv_id, min({'c': v.c, 'e': v.e, 't': v.t}) f
  from (select conv_id, unnest(s) v from dp where i = n) where v.q in (0, 3) group by conv_id),
cnt as (select conv_id, count(*) filter (where fault = 2) blank, count(*) filter (where fault = 3) duplicate,
  count(*) filter (where fault = 1) truncated, sum(illegal)::bigint illegal from r5 group by conv_id),
gap as (select conv_id, coalesce(max(turn) filter (where draw <> 0) - min(turn) filter (where draw <> 0) + 1
  - count(distinct turn) filter (where draw <> 0), 0)::bigint gaps from r1 group by conv_id)
select gap.conv_id, gaps, coalesce(blank, 0)::bigint blank, coalesce(duplicate, 0)::bigint duplicate,
  coalesce(truncated, 0)::bigint truncated, coalesce(illegal, 0)::bigint illegal, coalesce(f.c, 0)::bigint as cost,
  coalesce(f.e, '') audit, sha256(coalesce(array_to_string(f.t, chr(10)), '')) repaired_sha256
from gap left join fin on fin.conv_id is not distinct from gap.conv_id
  left join cnt on cnt.conv_id is not distinct from gap.conv_id
"""


@query("op13_glr_repair", OP13_SQL)
def op13_glr_repair(spark, sf_dir):
    """Faults of every conversation after planted damage, and its cheapest repair."""
    turns, gaps = _damaged(table(spark, sf_dir, "conversations"))
    bound_batches(spark)
    found = digest(repair(place(turns)))
    found = join_on(gaps, found.withColumnRenamed("conv", "conv_id"), ["conv_id"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(
        "conv_id", "gaps", *[zero(c) for c in SUMS], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
