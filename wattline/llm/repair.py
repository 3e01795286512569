"""Conversation structure repair by a persistent audit DP.

Turns are kept, reroled, deleted or inserted at the least cost so that the roles read: perhaps a system turn, then user
and assistant in turn. The audit is the string of these edits; of the cheapest the ASCII-least counts.

Prefixes of audits are shared: an edit is a node that points to the edit before it, and each of the four states (nothing
yet, after system, after user, after assistant) holds the node of its best prefix. Nodes carry a rolling hash of their
prefix and their ancestors at powers of two. Two prefixes of equal cost are compared at the first edit in which they
differ, found by lifting both along ancestors of unequal hash; where hashes say equal, nodes are compared edit by edit.

Once the states' prefixes have a common beginning, its edits are final: they leave as repaired turns, and their nodes go.
A task so walks a conversation of any length turn by turn, holding what is undecided only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed by the contract: white space, sentence ends, and the cost of each edit; a truncated turn that stays adds 1.
SPACE = "\\x20\\x09-\\x0D"
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
COST = {"D": 3, "I": 2, "K": 0, "R": 2}
LEGAL = ("su", "ua", "au")

#: States, and the state after a turn of a role; a state without the role as key does not allow it.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ENOUGH = (NONE, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}

#: From any state two inserts and, for a later system turn, one delete stand in for whatever another state can do, so a
#: prefix that costs more than this above the cheapest is part of no cheapest audit.
CATCH_UP = 2 * COST["I"] + COST["D"]

#: Undecided nodes at which a walk looks for a common beginning, first after so many.
FLUSH = 256
_BASE, _MOD = 1_000_003, (1 << 61) - 1
_INFINITE = 1 << 60


class Audits:
    """Audit prefixes as nodes of a tree: node 0 is the empty one."""

    def __init__(self):
        self.edit, self.row, self.depth, self.hash, self.up = [""], [None], [0], [0], [[]]

    def add(self, parent: int, edit: str, row=None) -> int:
        self.edit.append(edit)
        self.row.append(row)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(edit)) % _MOD)
        above, at, k = [parent], parent, 0
        while k < len(self.up[at]):
            at = self.up[at][k]
            above.append(at)
            k += 1
        self.up.append(above)
        return len(self.edit) - 1

    def lift(self, node: int, depth: int) -> int:
        """The ancestor at a depth."""
        while self.depth[node] > depth:
            k = (self.depth[node] - depth).bit_length() - 1
            node = self.up[node][k]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth and hash are really one string."""
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` is ASCII-less than that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, depth), self.lift(b, depth)
        if x == y or (self.hash[x] == self.hash[y] and self.same(x, y)):
            return self.depth[a] < self.depth[b]
        top = x, y
        for k in range(depth.bit_length() - 1, -1, -1):
            if k < len(self.up[x]):
                p, q = self.up[x][k], self.up[y][k]
                if self.hash[p] != self.hash[q]:
                    x, y = p, q
        p, q = self.up[x][0], self.up[y][0]
        if (p == q or self.same(p, q)) and self.edit[x] != self.edit[y]:
            return self.edit[x] < self.edit[y]
        return self._walk_less(*top)

    def _walk_less(self, x: int, y: int) -> bool:
        """The plain comparison, for prefixes whose hashes lied."""
        first = False
        while x != y:
            if self.edit[x] != self.edit[y]:
                first = self.edit[x] < self.edit[y]
            x, y = self.up[x][0], self.up[y][0]
        return first

    def path(self, node: int) -> list[int]:
        """Nodes from the first edit to this one."""
        out = []
        while node:
            out.append(node)
            node = self.up[node][0]
        return out[::-1]


class Walk:
    """The DP over one conversation's turns, in order."""

    def __init__(self):
        self.tree = Audits()
        self.best: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self.cost, self.state, self.flush_at = 0, NONE, FLUSH
        self._insert()

    def _better(self, table, state: int, cost: int, parent: int, edit: str, row) -> None:
        old = table[state]
        if old is not None and old[0] < cost:
            return
        node = self.tree.add(parent, edit, row)
        if old is None or cost < old[0] or self.tree.less(node, old[1]):
            table[state] = (cost, node)

    def _insert(self) -> None:
        for state in range(4):
            own = self.best[state]
            if own is None:
                continue
            for role, after in STEPS[state].items():
                if role in NAMES:
                    self._better(self.best, after, own[0] + COST["I"], own[1], "I", None)

    def turn(self, initial: str, must_go: bool, truncated: bool, row) -> None:
        table: list[tuple[int, int] | None] = [None] * 4
        for state, own in enumerate(self.best):
            if own is None:
                continue
            self._better(table, state, own[0] + COST["D"], own[1], "D", row)
            if must_go:
                continue
            for role, after in STEPS[state].items():
                if role in NAMES:
                    self._better(table, after, own[0] + COST["R"] + truncated, own[1], "R", row)
                if role == initial:
                    self._better(table, after, own[0] + COST["K"] + truncated, own[1], "K", row)
        self.best = table
        self._insert()
        least = min(own[0] for own in table if own is not None)
        self.best = [own if own is not None and own[0] <= least + CATCH_UP else None for own in table]

    def settled(self) -> list[tuple[str, str | None, object]]:
        """Edits that every state's prefix begins with: ``(edit, role after it or None, row)``; they leave the tree."""
        if len(self.tree.edit) < self.flush_at:
            return []
        paths = [self.tree.path(own[1]) for own in self.best if own is not None]
        n = 0
        while all(n < len(path) for path in paths) and len({path[n] for path in paths}) == 1:
            n += 1
        out = self._said(paths[0][:n])
        base = min(own[0] for own in self.best if own is not None)
        tree, known = Audits(), {paths[0][n - 1] if n else 0: 0}
        states = []
        for own in self.best:
            if own is None:
                states.append(None)
                continue
            for node in self.tree.path(own[1])[n:]:
                if node not in known:
                    known[node] = tree.add(known[self.tree.up[node][0]], self.tree.edit[node], self.tree.row[node])
            states.append((own[0] - base, known[own[1]]))
        self.tree, self.best, self.cost = tree, states, self.cost + base
        self.flush_at = 2 * len(tree.edit) + FLUSH
        return out

    def rest(self) -> list[tuple[str, str | None, object]]:
        """The edits that are left at the end of the conversation; ``cost`` is then the whole cost."""
        ends = [self.best[state] for state in ENOUGH if self.best[state] is not None]
        least = min(cost for cost, _ in ends)
        node = None
        for cost, other in ends:
            if cost == least and (node is None or self.tree.less(other, node)):
                node = other
        self.cost += least
        return self._said(self.tree.path(node))

    def _said(self, nodes: list[int]) -> list[tuple[str, str | None, object]]:
        out = []
        for node in nodes:
            edit, row, role = self.tree.edit[node], self.tree.row[node], None
            if edit == "K":
                role = row[0]
                self.state = STEPS[self.state][role[:1]]
            elif edit != "D":
                role = NAMES["a" if self.state == USER else "u"]
                self.state = ASSISTANT if self.state == USER else USER
            out.append((edit, role, row))
        return out


class _Conversation:
    """Counts, audit and digest of one conversation, fed turn by turn."""

    def __init__(self, key):
        self.key, self.walk = key, Walk()
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = self.n = 0
        self.low = self.high = self.last_turn = self.before = None
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.place = 0

    def take(self, turn, role: str, text: str, fault: str | None) -> list[tuple]:
        if turn is not None:
            self.distinct += turn != self.last_turn
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        if self.n and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        self.n += 1
        self.walk.turn(role[:1], fault in ("blank", "duplicate"), fault == "truncated", (role, text, turn))
        return self._write(self.walk.settled())

    def _write(self, edits) -> list[tuple]:
        rows = []
        for edit, role, row in edits:
            self.audit.append(edit)
            text = None
            if role is not None:
                text = row[1] if row else ""
                line = f"{role}:{text}"
                self.digest.update(("\n" if self.place else "").encode() + line.encode("utf-8", "surrogatepass"))
                self.place += 1
            rows.append((self.key, len(self.audit), edit, row[2] if row else None, role, text))
        return rows

    def end(self) -> tuple[list[tuple], tuple]:
        rows = self._write(self.walk.rest())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.walk.cost)
        return rows, (self.key, *counts, "".join(self.audit), self.digest.hexdigest())


def faults(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    here: str | None = None,
) -> DataFrame:
    """Turns by conversation and order, with their first fault: ``conv_id, turn, role, text, here, fault``.

    A turn is ``blank`` without a character that is no white space, ``duplicate`` if an earlier turn has its role and
    text, ``truncated`` if its last such character ends no sentence. Turns are ordered by turn, role and text, nulls
    first; a null role or text is one space. Rows of a conversation stay in one partition, sorted. Rows whose boolean
    column ``here`` is false only name their conversation.
    """
    said = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        (F.col(f"`{here}`") if here else F.lit(True)).alias("here"),
    )
    dealt = said.repartition("conv_id").withColumn("digest", F.md5(F.col("text").cast("binary")))
    # the same partitioning serves this window: one more sort, no shuffle; rows are streamed, not gathered
    earlier = Window.partitionBy("conv_id", "here", "role", "digest").orderBy("turn")
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (
        F.when(F.length(body) == 0, "blank").when(F.col("nth") > 1, "duplicate").when(~F.right(body, F.lit(1)).isin(*ENDS), "truncated")
    )
    return (
        dealt.withColumn("nth", F.row_number().over(earlier))
        .withColumn("fault", F.when(F.col("here"), fault))
        .sortWithinPartitions("conv_id", "turn", "role", "text", "nth")
        .drop("digest", "nth")
    )


def _walked(rows_wanted: bool):
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: _Conversation | None = None
        for batch in batches:
            rows, sums = [], []
            keys = batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None)
            order = batch["turn"].astype(object).where(batch["turn"].notna(), None)
            for key, turn, role, text, fault, here in zip(
                keys, order, batch["role"], batch["text"], batch["fault"], batch["here"]
            ):
                if own is None or own.key != key:
                    if own is not None:
                        more, whole = own.end()
                        rows += more
                        sums.append(whole)
                    own = _Conversation(key)
                if here:
                    rows += own.take(None if turn is None else int(turn), role, text, fault)
            yield pd.DataFrame(rows if rows_wanted else sums, columns=_ROWS if rows_wanted else _SUMS, dtype=object)
        if own is not None:
            more, whole = own.end()
            yield pd.DataFrame(more if rows_wanted else [whole], columns=_ROWS if rows_wanted else _SUMS, dtype=object)

    return walk


_ROWS = ["conv_id", "place", "edit", "turn", "role", "text"]
_SUMS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _whole_numbers(frame: DataFrame) -> DataFrame:
    return frame.withColumn("conv_id", F.col("conv_id").cast("string")).withColumn("turn", F.col("turn").cast("string"))


def audits(turns: DataFrame, conv_id: str = "conv_id", **columns) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``gaps`` are the turn numbers missing between the least and the greatest, ``illegal`` the neighbours whose roles must
    not follow each other, ``audit`` the edits' initials, the hash that of the repaired turns as ``role:text`` lines. A
    conversation whose rows are all not ``here`` (see ``faults``) has zeros, an empty audit and the hash of nothing. Null is a conversation of its own; repeated rows are duplicates; other
    columns play no part. Conversations are walked turn by turn, so their length is bound by the audit string alone.
    """
    kind = turns.schema[conv_id].dataType.simpleString()
    numbers = ", ".join(f"{name} bigint" for name in _SUMS[1:7])
    dealt = _whole_numbers(faults(turns, conv_id, **columns))
    found = dealt.mapInPandas(_walked(False), f"conv_id string, {numbers}, audit string, repaired_sha256 string")
    return found.withColumn("conv_id", F.col("conv_id").cast(kind))


def repaired(turns: DataFrame, conv_id: str = "conv_id", **columns) -> DataFrame:
    """One row per edit: ``conv_id, place, edit, turn, role, text``, in the audit's order by ``place`` from 1.

    Deleted turns have neither role nor text, inserted ones no turn and an empty text; a reroled one has its new role. The
    repaired conversation is what has a role. Edge cases as for ``audits``.
    """
    kind = turns.schema[conv_id].dataType.simpleString()
    dealt = _whole_numbers(faults(turns, conv_id, **columns))
    schema = "conv_id string, place bigint, edit string, turn bigint, role string, text string"
    return dealt.mapInPandas(_walked(True), schema).withColumn("conv_id", F.col("conv_id").cast(kind))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns of ``conv_id, turn, role, text`` with faults put in by the crc32 of ``conv_id:turn``, for tests and queries.

    Of twenty remainders 0 drops a turn (it stays with ``here`` false), 1 empties its text, 2 takes its sentence ends,
    3 repeats it, 4 makes it the user's. Nulls are one space.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    dice = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    return (
        turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), dice.alias("dice"))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("dice") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("dice") == 1, "")
            .when(F.col("dice") == 2, F.translate("text", ENDS, ""))
            .otherwise(F.col("text"))
            .alias("text"),
            (F.col("dice") != 0).alias("here"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("dice") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )
