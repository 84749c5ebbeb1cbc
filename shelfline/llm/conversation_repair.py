"""Conversation structure repair by a dynamic program over persistent audits.

The roles of a repaired conversation follow ``(s?(ua)+)?`` by their initials.
Edits of the rows in order: Keep (0), Rerole to the role that the pattern
wants next, user or assistant (2), Delete (3, required for blank and duplicate
rows), Insert an empty turn of that role anywhere (2); a truncated row that is
not deleted adds 1. The audit is the string of edit initials; the cheapest
one wins, ties go to the least in ASCII order.

The program keeps one cell per state of the pattern: cost and the last node
of its audit. Audits are linked nodes (``Audits``) that share their prefixes,
each with binary-lifting ancestors and the rolling hash of its string, so a
tie is decided in logarithmic steps: both ends are lifted to one depth, then
the ancestors with unequal hashes are followed down to the first difference.
Equal hashes of different nodes are verified character by character, so a
collision never decides. Edits are a function of state and initial, so the
audit alone gives the repaired rows. What all cells share is settled: it is
written out from time to time and its nodes are let go, so the nodes held are
those in which the cells still differ, not one for each row.

Rows of a conversation are one sequence in one task, in order of turn (nulls
first), role and text; its texts and its audit must fit there together. Equal
rows are one counted row before the shuffle: all but the first of them are
duplicates, so a row that is repeated without end costs its audit only.

Defined cases: a null role or text is one space; a null conv_id is a
conversation of its own; a null turn comes first and counts in no gap; rows
of one turn are ordered by role and text; a role without initial (empty) fits
nowhere and is deleted or reroled; blank goes before duplicate, duplicate
before truncated; very long texts are read whole; extra columns are not
carried (the result is one row per conversation); an empty table gives no
rows, a conversation without rows an empty audit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
# Pattern states: 0 start, 1 after s, 2 after u, 3 after a (0 and 3 may end).
START, SYSTEM, USER, ASSISTANT = range(4)
WANTED = "uuau"  # initial that each state inserts or reroles to
AFTER = [USER, USER, ASSISTANT, USER]
ENDS = (START, ASSISTANT)
NODES = 4096  # audit nodes that are made before the shared part is settled
RESULT = ("conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired array<struct<role:string,text:string>>")


class Audits:
    """Strings as nodes that share their prefixes; node 0 is the empty one."""

    def __init__(self, modulus: int = (1 << 61) - 1, base: int = 1_000_003):
        self.modulus, self.base = modulus, base
        self.depth, self.char, self.hash = [0], [""], [0]
        self.up: list[list[int]] = [[]]  # the ancestors 1, 2, 4, ... above

    def child(self, node: int, char: str) -> int:
        above, up, k = node, [node], 0
        while len(self.up[above]) > k:
            above = self.up[above][k]
            up.append(above)
            k += 1
        self.up.append(up)
        self.depth.append(self.depth[node] + 1)
        self.char.append(char)
        self.hash.append((self.hash[node] * self.base + ord(char)) % self.modulus)
        return len(self.up) - 1

    def ancestor(self, node: int, depth: int) -> int:
        k = 0
        rest = self.depth[node] - depth
        while rest:
            if rest & 1:
                node = self.up[node][k]
            rest >>= 1
            k += 1
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth hold equal strings."""
        if a == b or self.hash[a] != self.hash[b]:
            return a == b
        while a != b:
            if self.char[a] != self.char[b]:
                return False  # a collision
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.same(x, y):  # one is a prefix of the other
            return self.depth[a] < self.depth[b]
        k = len(self.up[x]) - 1
        while k >= 0:
            if k < len(self.up[x]) and not self.same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
            k -= 1
        return self.char[x] < self.char[y]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def common(self, nodes: list[int]) -> int:
        """The deepest node that all of ``nodes`` descend from."""
        top = nodes[0]
        for node in nodes[1:]:
            depth = min(self.depth[top], self.depth[node])
            x, y = self.ancestor(top, depth), self.ancestor(node, depth)
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]) and self.up[x][k] != self.up[y][k]:
                    x, y = self.up[x][k], self.up[y][k]
            top = x if x == y else self.up[x][0]
        return top

    def without(self, top: int, nodes: list[int]) -> tuple[Audits, list[int]]:
        """What ``nodes`` hold below their ancestor ``top``, as audits of
        their own, and the nodes there."""
        out, made = Audits(self.modulus, self.base), {top: 0}
        for node in nodes:
            path = []
            while node not in made:
                path.append(node)
                node = self.up[node][0]
            for old in reversed(path):
                made[old] = out.child(made[self.up[old][0]], self.char[old])
        return out, [made[n] for n in nodes]


class Repair:
    """The cells of one conversation; ``row`` feeds its rows in order."""

    def __init__(self, audits: Audits | None = None, nodes: int = NODES):
        self.audits = audits or Audits()
        self.cells: dict[int, tuple[int, int]] = {START: (0, 0)}
        self.settled: list[str] = []
        self.nodes = self.limit = nodes
        self._insert()

    def _offer(self, cells: dict, state: int, cost: int, node: int, edit: str) -> None:
        """Put the audit of ``node`` and one more ``edit`` into a cell if it
        is cheaper, or as cheap and smaller."""
        held = cells.get(state)
        if held is not None and held[0] < cost:
            return
        new = self.audits.child(node, edit)
        if held is None or cost < held[0] or self.audits.less(new, held[1]):
            cells[state] = (cost, new)

    def _insert(self) -> None:
        """Insertions at this place, cheapest cells first."""
        left = set(self.cells)
        while left:
            state = min(left, key=lambda s: self.cells[s][0])
            left.discard(state)
            cost, node = self.cells[state]
            before = self.cells.get(AFTER[state])
            self._offer(self.cells, AFTER[state], cost + 2, node, "I")
            if self.cells[AFTER[state]] is not before:
                left.add(AFTER[state])

    def row(self, initial: str, faulty: bool, truncated: bool) -> None:
        new: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in self.cells.items():
            self._offer(new, state, cost + 3, node, "D")
            if faulty:
                continue
            to = kept(state, initial)
            if to is not None:
                self._offer(new, to, cost + truncated, node, "K")
            self._offer(new, AFTER[state], cost + 2 + truncated, node, "R")
        self.cells = new
        self._insert()
        # Whatever follows from the start can follow from ASSISTANT at up to 3
        # more (a system row that only the start keeps is deleted), and from
        # SYSTEM at no more: a dearer cell cannot win.
        cost = new[ASSISTANT][0]
        for state, more in ((START, 3), (SYSTEM, 0)):
            if state in new and cost + more < new[state][0]:
                del new[state]
        if len(self.audits.up) > self.limit:
            self._settle()

    def _settle(self) -> None:
        """Write out the part that all audits share; keep the rest."""
        states, ends = zip(*((s, node) for s, (_, node) in self.cells.items()), strict=True)
        top = self.audits.common(list(ends))
        self.settled.append(self.audits.text(top))
        self.audits, ends = self.audits.without(top, list(ends))
        self.cells = {s: (self.cells[s][0], node) for s, node in zip(states, ends, strict=True)}
        self.limit = self.nodes + 2 * len(self.audits.up)

    def best(self) -> tuple[int, str]:
        """Cost and audit of the cheapest repair of the rows so far."""
        cost, node = min((self.cells[s] for s in ENDS if s in self.cells), key=lambda c: c[0])
        for s in ENDS:
            c, other = self.cells.get(s, (cost + 1, 0))
            if c == cost and other != node and self.audits.less(other, node):
                node = other
        return cost, "".join(self.settled) + self.audits.text(node)


def kept(state: int, initial: str) -> int | None:
    """The state after keeping a row, None where its role does not fit."""
    if initial == "s":
        return SYSTEM if state == START else None
    return AFTER[state] if initial == WANTED[state] else None


def apply(audit: str, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The repaired (role, text) rows of an audit."""
    out, state, at = [], START, iter(rows)
    for edit in audit:
        role, text = next(at) if edit != "I" else ("", "")
        if edit == "D":
            continue
        to = kept(state, role[:1]) if edit == "K" else AFTER[state]
        out.append((role if edit == "K" else ROLES[WANTED[state]], text))
        state = to
    return out


LEGAL = {"su", "ua", "au"}


def repair_rows(rows: list[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired)
    of one conversation's (turn, role, text, copies) in order."""
    seen: set = set()
    turns: set = set()
    n_blank = n_duplicate = n_truncated = illegal = 0
    flat: list[tuple[str, str]] = []
    last = None
    program = Repair()
    for turn, role, text, copies in rows:
        if not copies:
            continue
        if turn is not None:
            turns.add(turn)
        core = text.strip(WHITE)
        again = (role, text) in seen
        seen.add((role, text))
        initial = role[:1]
        for i in range(copies):
            blank, duplicate = not core, bool(core) and (again or i > 0)
            cut = bool(core) and not duplicate and core[-1] not in ".!?"
            n_blank += blank
            n_duplicate += duplicate
            n_truncated += cut
            illegal += last is not None and last + initial not in LEGAL
            last = initial
            flat.append((role, text))
            program.row(initial, blank or duplicate, cut)
    cost, audit = program.best()
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, n_blank, n_duplicate, n_truncated, illegal, cost, audit, apply(audit, flat)


def repair(conversations: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per conv_id of (conv_id, turn, role, text) rows: the faults,
    the cheapest edits and the repaired rows. ``copies`` names a column that
    says how often a row stands (0: not at all, its conv_id is returned)."""
    one = F.lit(" ")
    rows = (conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", one).alias("role"),
        F.coalesce("text", one).alias("text"), (F.col(copies) if copies else F.lit(1)).cast("long").alias("copies"))
        .groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def feed():
            for b in batches:
                yield from zip(*(b[c].astype(object).where(b[c].notna(), None)
                                 for c in ("conv_id", "turn", "role", "text", "copies")), strict=True)
        out: list[tuple] = []
        size = 0
        for conv, own in groupby(feed(), key=lambda r: r[0]):
            found = repair_rows([(None if t is None else int(t), role, text, int(n)) for _, t, role, text, n in own])
            out.append((conv, *found[:-1], [{"role": r, "text": t} for r, t in found[-1]]))
            size += sum(len(t) for _, t in found[-1]) + len(found[-2])
            if size > 1 << 20 or len(out) == 1000:
                yield pd.DataFrame(out, columns=names, dtype=object)
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=names, dtype=object)

    schema = RESULT.format(conversations.schema["conv_id"].dataType.simpleString())
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"]
    return ordered.mapInPandas(run, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the
    row (copies 0), 1 empties its text, 2 takes out ``[.!?]``, 3 repeats it
    (copies 2), 4 sets the role user. Nulls are one space."""
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), one))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", one).alias("role"),
                                F.coalesce("text", one).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    kind = F.col("kind")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def digests(conversations: DataFrame) -> DataFrame:
    """The repair of the damaged conversations, its rows as a hash."""
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    found = repair(damage(conversations), copies="copies")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                        F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
