"""Spelling variants: words one edit apart, found by composing the vocabulary with a one-edit transducer.

The vocabulary is a minimised acceptor A. A transducer T copies letters and makes exactly one change:
it inserts, deletes or replaces a letter. The pairs accepted by A o T o A are the near words. A state of
the composition is (state of A, change made yet?, state of A); before the change both states of A are
the same one, after it both must read the same letters.

The composition is enumerated in parts, each from an initial state of its own: the state that A is in
after the first letters. As a change falls behind the first ``share`` letters or before the last
``share`` ones, a word is in one part of A and in one part of the acceptor of the reversed words.
A part of too many words is cut: changes right at its initial state are read off the composition there,
and the words go on to the states that follow.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored, texts_as_bytes

#: Different words that a task counts before it hands them on.
HELD_WORDS = 200_000


@dataclass(frozen=True)
class Rules:
    """What counts as a word, and as its form.

    ``drop_one_in``: a run whose hash is divisible by it loses a letter, which plants variants.
    ``part_words``: a part of more words is cut.
    """

    least_letters: int = 6
    least_count: int = 5
    form_factor: int = 5
    drop_one_in: int = 199
    part_words: int = 2000

    @property
    def share(self) -> int:
        return self.least_letters // 2


def _counter(rules: Rules):
    # Runs are maximal, as the repetition is greedy; shorter ones cannot become words.
    runs = re.compile(f"[a-zÀ-ÿ]{{{max(1, rules.least_letters)},}}")

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), texts_as_bytes(batch.column("text")), strict=True):
                start = zlib.crc32(f"{key}:".encode())
                for run, times in Counter(runs.findall(text.lower().decode())).items():
                    code = zlib.crc32(run.encode(), start)
                    if code % rules.drop_one_in == 0:
                        at = code % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < rules.least_letters:
                            continue
                    counts[run] += times
                if len(counts) >= HELD_WORDS:
                    yield out(counts)
                    counts = Counter()
        yield out(counts)

    return count


def vocabulary(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``word, n`` of all words that are long and common enough."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counts = rows.mapInArrow(_counter(rules), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rules.least_count)


class Acceptor:
    """The least deterministic acceptor of a sorted list of different words.

    ``final[q]`` says whether a word may end in state q, ``arcs[q]`` maps letters to states.
    """

    def __init__(self, words: list[str]) -> None:
        self.final: list[bool] = []
        self.arcs: list[dict[str, int]] = []
        known: dict[tuple, int] = {}
        path: list[tuple[list[bool], dict[str, int]]] = [([False], {})]
        before = ""

        def close(depth: int) -> None:
            """States of the last word below ``depth`` get no more arcs: merge each with its equal."""
            while len(path) > depth + 1:
                (final,), arcs = path.pop()
                path[-1][1][before[len(path) - 1]] = self._state(known, final, arcs)

        for word in words:
            shared = 0
            while shared < min(len(before), len(word)) and before[shared] == word[shared]:
                shared += 1
            close(shared)
            path.extend(([False], {}) for _ in word[shared:])
            path[-1][0][0] = True
            before = word
        close(0)
        (final,), arcs = path.pop()
        self.start = self._state(known, final, arcs)

    def _state(self, known: dict[tuple, int], final: bool, arcs: dict[str, int]) -> int:
        key = (final, tuple(arcs.items()))
        if key not in known:
            known[key] = len(self.final)
            self.final.append(final)
            self.arcs.append(arcs)
        return known[key]

    def _live(self, memo: dict[tuple[int, int], bool], first: tuple[int, int]) -> bool:
        """Do both states accept a common rest? Worked out once for every state pair that is met."""
        todo = [first]
        while todo:
            p, q = pair = todo[-1]
            if pair in memo:
                todo.pop()
                continue
            if p == q or (self.final[p] and self.final[q]):
                memo[pair] = True
                continue
            few, many = sorted((self.arcs[p], self.arcs[q]), key=len)
            after = [(self.arcs[p][c], self.arcs[q][c]) for c in few if c in many]
            unknown = [x for x in after if x not in memo]
            if any(memo.get(x) for x in after) or not unknown:
                memo[pair] = any(memo.get(x) for x in after)
            else:
                todo += unknown
        return memo[first]

    def _common(self, memo: dict, p: int, q: int, without: str = "") -> Iterator[str]:
        """The rests that both states accept, but for those beginning with ``without``."""
        todo = [(p, q, "", without)]
        while todo:
            p, q, rest, without = todo.pop()
            if self.final[p] and self.final[q]:
                yield rest
            others = self.arcs[q]
            for letter, after in self.arcs[p].items():
                if letter != without and letter in others and self._live(memo, (after, others[letter])):
                    todo.append((after, others[letter], rest + letter, ""))

    def near(self) -> Iterator[tuple[str, str]]:
        """Every pair of accepted words one change apart, once, in one of its two orders.

        A change is made as late as possible: a deleted letter is not the one that follows.
        """
        memo: dict[tuple[int, int], bool] = {}
        todo = [(self.start, "")]
        while todo:
            state, read = todo.pop()
            arcs = list(self.arcs[state].items())
            for at, (letter, after) in enumerate(arcs):
                todo.append((after, read + letter))
                for rest in self._common(memo, after, state, letter):
                    yield read + letter + rest, read + rest
                for other, beside in arcs[at + 1 :]:
                    if self._live(memo, (after, beside)):
                        for rest in self._common(memo, after, beside):
                            yield read + letter + rest, read + other + rest


def _enumerated(share: int):
    """The near pairs of one part; in the reversed part only those that no other part has."""

    def part(table: pa.Table) -> pa.Table:
        counts = dict(zip(table.column("spelt").to_pylist(), table.column("n").to_pylist(), strict=True))
        backward = table.column("backward")[0].as_py()
        found = []
        for a, b in Acceptor(sorted(counts)).near():
            pair = (a[::-1], b[::-1]) if backward else (a, b)
            if not backward or pair[0][:share] != pair[1][:share]:
                found.append((pair[0], counts[a], pair[1], counts[b]))
        columns = zip(*found, strict=True) if found else [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "a_n", "b", "b_n"])

    return part


def _start(length: str) -> Column:
    return F.expr(f"substring(spelt, 1, {length})")


#: Letters that the least and the greatest word of a part have in common, and so all of its words.
_SHARED = """coalesce(nullif(array_position(transform(sequence(1, greatest(1, length(low))),
    i -> substring(low, i, 1) = substring(high, i, 1)), false), 0) - 1, length(low))"""


def near_pairs(words: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of near words once, from ``word, n`` with different words.

    Words have ``rules.least_letters`` letters at least.
    """
    forward = words.select(F.lit(False).alias("backward"), F.col("word").alias("spelt"), "n")
    both = forward if not rules.share else forward.unionByName(words.select(F.lit(True).alias("backward"), F.reverse("word").alias("spelt"), "n"))
    open_parts = stored(both.withColumn("depth", F.lit(rules.share)), "words")
    ready, edges = [], []
    while True:
        parts = open_parts.groupBy("backward", "depth", _start("depth").alias("part"))
        sizes = parts.agg(F.count("*").alias("size"), F.min("spelt").alias("low"), F.max("spelt").alias("high"))
        large = sizes.filter(F.col("size") > rules.part_words).select(
            F.col("backward").alias("back"), "depth", "part", F.expr(_SHARED).alias("shared")
        )
        large = stored(large, "large-parts")
        here = open_parts.withColumn("part", _start("depth")).withColumnRenamed("backward", "back")
        marked = here.join(large, ["back", "depth", "part"], "left").withColumnRenamed("back", "backward")
        ready.append(marked.filter("shared is null").select("backward", "part", "spelt", "n"))
        if large.isEmpty():
            break
        # All words of a large part agree up to ``shared``; the next letter is the first that can change.
        cut = stored(marked.filter("shared is not null").select("backward", "shared", "spelt", "n"), "cut")
        edges.append(cut)
        longer = cut.filter("length(spelt) > shared")
        open_parts = stored(longer.select("backward", "spelt", "n", (F.col("shared") + 1).alias("depth")), "words")
    parts = ready[0]
    for more in ready[1:]:
        parts = parts.unionByName(more)
    pairs = parts.groupBy("backward", "part").applyInArrow(_enumerated(rules.share), "a string, a_n long, b string, b_n long")
    for cut in edges:
        pairs = pairs.unionByName(_edge_pairs(cut, rules.share))
    return pairs


def _edge_pairs(cut: DataFrame, share: int) -> DataFrame:
    """Near words that part at the very letter behind ``shared``.

    They meet under what is read before and after the change: words that lose this letter, and the one
    word that has none there. A group has as many words as there are letters, and one, at most.
    """
    start, rest = _start("shared").alias("start"), F.expr("substring(spelt, shared + 2)").alias("rest")
    lost = cut.filter("length(spelt) > shared").select(
        "backward", start, rest, F.struct(F.expr("substring(spelt, shared + 1, 1)").alias("letter"), "spelt", "n").alias("w")
    )
    whole = cut.select("backward", start, F.expr("substring(spelt, shared + 1)").alias("rest"), F.struct(F.lit("").alias("letter"), "spelt", "n").alias("w"))
    met = lost.unionByName(whole).groupBy("backward", "start", "rest").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    pairs = F.flatten(
        F.transform("ws", lambda a: F.transform(F.filter("ws", lambda b: b["letter"] > a["letter"]), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    )
    found = met.filter(F.size("ws") > 1).select("backward", "rest", F.explode(pairs).alias("p"))
    # A word that has nothing there pairs with a lost letter only if its own next letter is another one.
    latest = (F.col("p.a.letter") != "") | (F.col("p.b.letter") != F.expr("substring(rest, 1, 1)"))
    spelt = [F.when(F.col("backward"), F.reverse(F.col(f"p.{s}.spelt"))).otherwise(F.col(f"p.{s}.spelt")) for s in "ab"]
    rows = found.filter(latest).select("backward", spelt[0].alias("a"), F.col("p.a.n").alias("a_n"), spelt[1].alias("b"), F.col("p.b.n").alias("b_n"))
    new = ~F.col("backward") | (F.expr(f"substring(a, 1, {share})") != F.expr(f"substring(b, 1, {share})"))
    return rows.filter(new).drop("backward")


def variants(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the whole texts of ``docs``.

    ``form`` is the commonest near word (ties: the first in code-point order) if it is
    ``rules.form_factor`` times as common, else null; ``root`` ends the chain of forms. Null texts have
    no words; a null ``doc_id`` counts as an empty one; repeated rows count again; other columns are not
    looked at. No words give an empty table.
    """
    words = stored(vocabulary(docs, rules), "vocabulary")
    pairs = stored(near_pairs(words, rules), "near-pairs")
    ways = pairs.select("a", "b", "b_n").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    near = ways.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("rank"), F.col("b").alias("form"))).alias("best")
    )
    counted = words.join(near, "word", "left")
    common = -F.col("best.rank") >= rules.form_factor * F.col("n")
    table = stored(
        counted.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, F.col("best.form")).alias("form"),
            F.when(common, -F.col("best.rank")).alias("form_n"),
        ),
        "forms",
    )
    roots = stored(table.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        # Each round doubles the steps followed; counts grow along a chain, so it has no circle.
        further = roots.join(roots.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        further = stored(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = further.select("word", "root")
        if further.filter("moved").isEmpty():
            break
    return table.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
