"""What a revised data model needs to know of its tables: keys, dependencies, references.

All three compare numbers of different values. A set of columns that has as many different rows as
the table is a key; a set that has as many with a further column as without determines that
column; a column all whose values stand in another may refer to it.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import batched, combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

from millrace.operators.agreement import NOT_ALL, Base, Claims, contradictions, largest_groups
from millrace.session import settings, stage

#: Columns per mask word, and columns that a search for dependencies takes.
WORD_BITS, MAX_COLUMNS = 62, 60
#: Of the groups of a set, one in so many is looked at before all are counted.
SHARES = (512, 64, 8)
#: A job that counts sets makes as many rows as the table has, or this many if that is more.
LEAST_ROWS = 4_000_000
#: Rows from which a table is dealt out by columns that sets share, and the types that this compares.
DEALT_ROWS = 50_000
DEALT_TYPES = (
    BinaryType, BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType,
    IntegerType, LongType, ShortType, TimestampNTZType, TimestampType,
)
#: Rows and bytes meant for a task that compares dealt rows, and the bytes that it holds at most.
TASK_ROWS, TASK_BYTES, MOST_BYTES = 500_000, 32 << 20, 128 << 20
#: Of the values of what rows are dealt by, one in so many is looked at first if that leaves so many rows.
DEALT_SHARE, LEAST_SHARE = 64, 50_000
#: The files of a shuffle go when its job ends, not when the driver next collects garbage.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
Columns = frozenset[str]
Pair = tuple[Columns, str]


def dependencies(df: DataFrame, max_columns: int, sample_rows: int = 100_000) -> DataFrame:
    """(kind, determinant, dependent): minimal keys and functional dependencies.

    A row of kind ``key`` names up to ``max_columns`` columns that tell all rows apart, none of which can
    be left out; its dependent is null. A ``dependency`` names up to ``max_columns`` - 1
    columns, which hold no key, and one that they determine; the empty name determines a constant.
    Names are joined by commas in the table's order. Nulls are equal to each other, as in a grouping.
    A table without rows has neither.

    Sets are tried level by level. A set with a key or a dependency inside is not tried, as nothing
    minimal can come from it. What a few rows contradict is not asked of all: ``sample_rows`` rows, and
    then shares of the groups, can only refute, and all that they do not refute is asked of the whole
    table. A large one is dealt out by columns that many sets share, and each task compares its rows on all of
    those sets (``_Dealt``). A smaller one, one with types that this does not take, and sets whose columns all
    repeat a value too often, are counted: a job counts as many sets as keep the rows that it makes at the
    table's number, so the disk it takes grows with the table and not with the number of sets. Only counts
    reach the driver. The table should be a stored one, as it is read several times.
    """
    columns = df.columns
    if len(columns) > MAX_COLUMNS:
        raise ValueError(f"{len(columns)} columns; at most {MAX_COLUMNS}")
    whole = _Counts(df)
    tables: list[_Counts | _Slices | _Dealt] = [whole]  # small ones first: most sets are refuted by few rows
    if whole.rows >= DEALT_ROWS and all(_is_dealt(f.dataType) for f in df.schema):
        tables = [_Dealt(whole, max_columns, sample_rows)]
    elif whole.rows > sample_rows:
        witnesses = _witnesses(df, whole.rows, sample_rows)
        few = stage(witnesses.sample(0.1, seed=0), "witnesses")
        slices = [_Slices(df, whole.rows, n) for n in SHARES if whole.rows // n >= sample_rows // 10]
        tables = [_Counts(few), _Counts(witnesses), *slices, whole]
    keys, found = _search(tables, columns, max_columns) if whole.rows else ([], [])

    def name(of: Columns) -> str:
        return ",".join(c for c in columns if c in of)

    rows = [("key", name(k), None) for k in keys] + [("dependency", name(x), a) for x, a in found]
    return df.sparkSession.createDataFrame(rows, "kind string, determinant string, dependent string")


def _witnesses(df: DataFrame, rows: int, sample_rows: int) -> DataFrame:
    """Rows that are likely to contradict a key or a dependency.

    Two rows contradict if they agree on some columns, so for each column with many values all rows
    with a few of these are taken; plain rows do for the other columns. Stored, since
    counts that are compared must be of the same rows.
    """
    buckets = -(-2 * rows * len(df.columns) // sample_rows)
    several = df.agg(*[F.approx_count_distinct(f"`{c}`").alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    agreeing = F.lit(False)
    for i, c in enumerate(df.columns):
        if several[i] >= 2 * buckets:
            agreeing |= F.pmod(F.xxhash64(f"`{c}`"), F.lit(buckets)) == 0
    part = sample_rows // 2
    return stage(df.filter(agreeing).limit(part).union(df.filter(~agreeing).limit(part)), "witnesses")


class _Counts:
    """Numbers of different rows by set of columns; each set is counted once."""

    def __init__(self, df: DataFrame):
        self.df, self.rows = df, df.count()
        self.known: dict[Columns, int] = {frozenset(): min(self.rows, 1)}

    def of(self, sets: Iterable[Columns]) -> dict[Columns, int]:
        lacking = sorted({s for s in sets if s not in self.known}, key=sorted)
        for part in batched(lacking, _sets_of_a_job(self.rows)):
            self._count(part)
        return self.known

    def _count(self, lacking: tuple[Columns, ...]) -> None:
        names = [c for c in self.df.columns if any(c in s for s in lacking)]
        quoted = {c: F.col(f"`{c}`") for c in names}
        top = len(names) - 1
        # The bit of a column is set in the id of the sets that leave it out.
        ids = {sum(1 << (top - i) for i, c in enumerate(names) if c not in s): s for s in lacking}
        grouped = self.df.groupingSets([[quoted[c] for c in s] for s in lacking], *quoted.values())
        with settings(self.df.sparkSession, CLEANED):
            numbers = grouped.agg(F.grouping_id().alias("_set")).groupBy("_set").count().collect()
        self.known.update((ids[r["_set"]], r["count"]) for r in numbers)
        self.known.update((s, 0) for s in lacking if s not in self.known)

    def unique(self, sets: list[Columns]) -> list[Columns]:
        n = self.of(sets)
        return [s for s in sets if n[s] == self.rows]

    def determined(self, pairs: list[Pair]) -> list[Pair]:
        n = self.of(part for s, a in pairs for part in (s, s | {a}))
        return [(s, a) for s, a in pairs if n[s] == n[s | {a}]]


class _Slices:
    """One in ``share`` groups of each set, by a hash of its values.

    Rows that agree on a set are in its slice together or not at all, so what many groups
    contradict is refuted without a shuffle of the table.
    """

    def __init__(self, df: DataFrame, rows: int, share: int):
        self.df, self.rows, self.share = df, rows, share

    def unique(self, sets: list[Columns]) -> list[Columns]:
        n = self._of([(s, s) for s in sets if s])
        return [s for s in sets if not s or n[s, s][0] == n[s, s][1]]

    def determined(self, pairs: list[Pair]) -> list[Pair]:
        n = self._of([(s, part) for s, a in pairs if s for part in (s, s | {a})])
        return [(s, a) for s, a in pairs if not s or n[s, s][0] == n[s, s | {a}][0]]

    def _of(self, wanted: list[tuple[Columns, Columns]]) -> dict[tuple[Columns, Columns], tuple[int, int]]:
        """Different rows, and rows, of the second set in the slice of the first."""
        known = dict.fromkeys(wanted, (0, 0))
        in_order = sorted(known, key=lambda sets: (sorted(sets[0]), sorted(sets[1])))
        for part in batched(in_order, _sets_of_a_job(self.rows, self.share)):
            with settings(self.df.sparkSession, CLEANED):
                found = self._counted(part).collect()
            known.update((part[r["_set"]], (r["different"], r["rows"])) for r in found)
        return known

    def _counted(self, part: tuple[tuple[Columns, Columns], ...]) -> DataFrame:
        names = [c for c in self.df.columns if any(c in s for _, s in part)]
        held: dict[Columns, list[int]] = {}
        for i, (base, _) in enumerate(part):
            held.setdefault(base, []).append(i)
        chosen = [
            F.when(
                F.pmod(F.xxhash64(*[f"`{c}`" for c in names if c in base]), F.lit(self.share)) == 0,
                F.array(*map(F.lit, ids)),
            )
            for base, ids in held.items()
        ]
        rows = self.df.select(*[f"`{c}`" for c in names], F.explode(F.array(*chosen)).alias("_sets"))
        rows = rows.filter(F.col("_sets").isNotNull()).withColumn("_set", F.explode("_sets"))
        values = [
            F.when(F.col("_set").isin([i for i, (_, s) in enumerate(part) if c in s]), F.col(f"`{c}`")).alias(f"_{k}")
            for k, c in enumerate(names)
        ]
        groups = rows.select("_set", *values).groupBy("_set", *[f"_{k}" for k in range(len(names))])
        return (
            groups.agg(F.count(F.lit(1)).alias("_rows"))
            .groupBy("_set")
            .agg(F.count(F.lit(1)).alias("different"), F.sum("_rows").alias("rows"))
        )


class _Dealt:
    """What rows contradict that are dealt out by columns that many sets share.

    Rows that agree on a set agree on its part by which they are dealt, so they meet in a task, which
    compares its rows on every set with that part. A part is taken if few rows share a value of it. Sets
    without such a part, and what a task could not hold, are counted over the whole table.
    """

    def __init__(self, whole: _Counts, max_columns: int, sample_rows: int):
        self.whole, self.rows, self.columns = whole, whole.rows, whole.df.columns
        self.df = whole.df.select(
            *[_one_form(f.dataType, F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(whole.df.schema)]
        )
        places = range(len(self.columns))
        #: (base, None): that it is a key; (base, column): that it determines the column.
        self.claims: list[tuple[frozenset[int], int | None]] = []
        for size in range(min(max_columns, len(places)) + 1):
            for base in map(frozenset, combinations(places, size)):
                self.claims.append((base, None))
                if size < max_columns:
                    self.claims += [(base, c) for c in places if c not in base]
        self.numbers = {claim: n for n, claim in enumerate(self.claims)}
        #: Claims that nothing contradicts so far, and those of them that hold in the whole table.
        self.left, self.held = set(self.numbers.values()), set()
        #: Share of the rows that has the same value of a part, and bytes of a column's values, by plain rows.
        self.top: dict[frozenset[int], float] = {}
        self.bytes = [0.0] * len(self.columns)
        #: Share of the rows that may have the same value of the part by which they are dealt.
        self.enough = max(TASK_ROWS / 4 / self.rows, 8 / sample_rows)
        self._witnessed(sample_rows)
        self._counted(max_columns)
        self._dealt()

    def unique(self, sets: list[Columns]) -> list[Columns]:
        asked = {s: self._number(s, None) for s in sets}
        counted = set(self.whole.unique([s for s, n in asked.items() if n in self.left - self.held]))
        return [s for s, n in asked.items() if n in self.held or s in counted]

    def determined(self, pairs: list[Pair]) -> list[Pair]:
        asked = {(s, a): self._number(s, a) for s, a in pairs}
        counted = set(self.whole.determined([p for p, n in asked.items() if n in self.left - self.held]))
        return [p for p, n in asked.items() if n in self.held or p in counted]

    def _number(self, of: Columns, determined: str | None) -> int:
        place = self.columns.index
        return self.numbers[frozenset(map(place, of)), None if determined is None else place(determined)]

    def _witnessed(self, sample_rows: int) -> None:
        """Refute by plain rows, and by all rows with a few of the values of each column."""
        share = -(-2 * self.rows * len(self.columns) // sample_rows)
        agreeing = F.lit(False)
        for c in self.df.columns:
            agreeing |= F.pmod(F.xxhash64(c), F.lit(share)) == 0
        plain = F.rand(0) < sample_rows / 2 / self.rows
        rows = self.df.select("*", plain.alias("plain")).filter(agreeing | F.col("plain")).limit(3 * sample_rows)
        witnesses = stage(rows, "witnesses")
        by_task: dict[int, dict[Base, Claims]] = {}
        for n in self.left:
            base = tuple(sorted(self.claims[n][0]))
            _add(by_task.setdefault(base[0] if base else 0, {}), base, self.claims[n][1], n)
        tasks = F.explode(F.array(*map(F.lit, sorted(by_task))))
        dealt = witnesses.drop("plain").withColumn("task", tasks).repartition(len(by_task), "task")
        self.left -= self._contradicted(dealt, by_task, whole=False)
        # A part that many rows share a value of would leave its rows to one task.
        bases = [tuple(sorted(b)) for b in {self.claims[n][0] for n in self.left}]
        counted = (
            witnesses.filter("plain")
            .drop("plain")
            .coalesce(1)
            .mapInArrow(largest_groups(bases, self.enough), "columns array<int>, top bigint, bytes bigint")
            .collect()
        )
        several = max((r["top"] for r in counted if not r["columns"]), default=1)
        for r in counted:
            self.top[frozenset(r["columns"])] = r["top"] / several
            if len(r["columns"]) == 1:
                self.bytes[r["columns"][0]] = r["bytes"] / several

    def _counted(self, max_columns: int) -> None:
        """Count what has no part to be dealt by. Nothing larger implies it, and it may imply what is larger."""
        for size in range(max_columns + 1):
            asked = [n for n in self._open(late=False) if len(self.claims[n][0]) == size]
            asked = [n for n in asked if size == 0 or self.top.get(self.claims[n][0], 0) > self.enough]
            named = {n: frozenset(self.columns[i] for i in self.claims[n][0]) for n in asked}
            pairs = {(named[n], self.columns[c]): n for n in asked if (c := self.claims[n][1]) is not None}
            keys = {named[n]: n for n in asked if self.claims[n][1] is None}
            holds = {pairs[p] for p in self.whole.determined([*pairs])} | {keys[s] for s in self.whole.unique([*keys])}
            self.held |= holds
            self.left -= set(asked) - holds

    def _dealt(self) -> None:
        full: set[frozenset[int]] = set()  # parts with a task that could not hold its rows
        if self.rows // DEALT_SHARE >= LEAST_SHARE:
            seen: set[int] = set()
            while part := self._part(left := self._open(late=False) - seen, left, full):
                own = {n for n in left if part <= self.claims[n][0]}
                self.left -= self._compared(part, own, DEALT_SHARE)
                seen |= own
        while True:
            asked, late = self._open(late=False), self._open(late=True)
            part = self._part(late, asked, full) or self._part(asked, asked, full)
            if not part:
                break
            asked = {n for n in asked if part <= self.claims[n][0]}
            # What follows from an open key comes along if it needs no further column.
            columns = part.union(*[self._columns(n) for n in asked & late or asked])
            own = {n for n in asked if self._columns(n) <= columns}
            found = self._compared(part, own, 1)
            self.left -= found
            if NOT_ALL in found:
                full.add(part)
            else:
                self.held |= own - found

    def _columns(self, number: int) -> frozenset[int]:
        base, determined = self.claims[number]
        return base if determined is None else base | {determined}

    def _open(self, late: bool) -> set[int]:
        """Claims that neither hold for certain nor follow from what does, or, if ``late``, from a key that is open."""
        keys = [self.claims[n][0] for n in (self.left if late else self.held) if self.claims[n][1] is None]
        pairs = [self.claims[n] for n in self.held if self.claims[n][1] is not None]

        def follows(base: frozenset[int], c: int | None) -> bool:
            return any(k < base or k == base and c is not None for k in keys) or any(
                x <= base and (a in base or a == c) for x, a in pairs
            )

        return {n for n in self.left - self.held if not follows(*self.claims[n])}

    def _part(self, of: set[int], tied: set[int], full: set[frozenset[int]]) -> frozenset[int] | None:
        """Columns to deal rows by: those that the most bases hold, but for what many rows share."""
        bases, others = {self.claims[n][0] for n in of}, {self.claims[n][0] for n in tied}
        parts = {p for p, top in self.top.items() if p and top <= self.enough and p not in full}
        parts |= {b for b in bases if b and b not in full and self.top.get(b, 0) <= self.enough}
        held = {p: sum(p <= b for b in bases) for p in parts}
        most = max(held.values(), default=0)
        best = [p for p in parts if held[p] == most]
        return min(best, key=lambda p: (-sum(p <= b for b in others), self.top.get(p, 0), sorted(p))) if most else None

    def _compared(self, part: frozenset[int], own: set[int], share: int) -> set[int]:
        """Numbers of the claims that all groups of that part, or one in ``share``, contradict."""
        columns = sorted(part.union(*map(self._columns, own)))
        claims: dict[Base, Claims] = {}
        for n in own:
            base, c = self.claims[n]
            in_order = sorted(base, key=lambda i: (i not in part, self.top.get(frozenset([i]), 0), i))
            _add(claims, tuple(map(columns.index, in_order)), None if c is None else columns.index(c), n)
        by = [f"_{i}" for i in sorted(part)]
        rows = self.rows // share
        width = sum(self.bytes[i] for i in columns)
        least = min(int(self.df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // 50_000)
        tasks = max(least, -(-rows // TASK_ROWS), int(rows * width) // TASK_BYTES, 1)
        dealt = self.df.filter(F.pmod(F.xxhash64(*by), F.lit(share)) == 0) if share > 1 else self.df
        dealt = dealt.select(*[f"_{i}" for i in columns]).repartition(tasks, *by).withColumn("task", F.lit(0))
        return self._contradicted(dealt, {0: claims}, whole=share == 1)

    def _contradicted(self, dealt: DataFrame, by_task: dict[int, dict[Base, Claims]], whole: bool) -> set[int]:
        with settings(dealt.sparkSession, CLEANED):
            found = dealt.mapInArrow(contradictions(by_task, MOST_BYTES, whole), "claim int").distinct().collect()
        return {r["claim"] for r in found}


def _add(claims: dict[Base, Claims], base: Base, determined: int | None, number: int) -> None:
    own = claims.setdefault(base, Claims())
    if determined is None:
        own.key = number
    else:
        own.dependents[determined] = number


def _is_dealt(kind: DataType) -> bool:
    plain_text = isinstance(kind, StringType) and kind.simpleString() == "string"
    return plain_text or isinstance(kind, DEALT_TYPES)


def _one_form(kind: DataType, value: Column) -> Column:
    """Values that a grouping takes as equal, as the same bits: one zero, one that is not a number."""
    if isinstance(kind, (FloatType, DoubleType)):
        zero = F.lit(0).cast(kind)
        return F.when(F.isnan(value), F.lit(float("nan")).cast(kind)).otherwise(value + zero)
    return value


def _sets_of_a_job(rows: int, share: int = 1) -> int:
    return max(1, max(rows, LEAST_ROWS) * share // max(rows, 1))


def _search(
    tables: list[_Counts | _Slices | _Dealt], columns: list[str], max_columns: int
) -> tuple[list[Columns], list[Pair]]:
    """Keys and dependencies that no table contradicts; the last table is the whole one."""
    keys: list[Columns] = []
    found: list[Pair] = []

    def holds_key(s: Columns) -> bool:
        return any(k <= s for k in keys)

    for size in range(max_columns + 1):
        level = [
            s
            for s in map(frozenset, combinations(columns, size))
            if not holds_key(s) and not any(a in s and x <= s for x, a in found)
        ]
        new_keys = level
        for rows in tables:
            new_keys = rows.unique(new_keys)
        keys += new_keys
        if size == max_columns:
            break
        determined = [
            (s, a)
            for s in level
            if not holds_key(s)
            for a in columns
            if a not in s and not holds_key(s | {a}) and not any(b == a and x <= s for x, b in found)
        ]
        for rows in tables:
            determined = rows.determined(determined)
        found += determined
    return keys, found


def inclusions(tables: dict[str, DataFrame], columns: list[tuple[str, str]], least: float = 1.0) -> DataFrame:
    """(child, parent, child_values, shared_values): columns whose values stand in another column.

    ``columns`` are pairs of table and column; all pairs of them with comparable types are tried, and kept
    if at least that share of the child's different values is found in the parent. Whole numbers of
    any width are comparable, other types with themselves only. Nulls are no values, and
    a column without values refers to nothing.

    A value travels once, with the set of columns that have it; what follows has a row per
    different set. Repeated values meet before the shuffle, so a hot value is one row.
    """
    if len(set(columns)) != len(columns):
        raise ValueError("a column is named twice")
    words = range(-(-len(columns) // WORD_BITS))
    by_table: dict[str, list[Column]] = {}
    for place, (name, column) in enumerate(columns):
        kind, text = _comparable(tables[name].schema[column].dataType, F.col(f"`{column}`"))
        mask = [
            F.lit(1 << (place % WORD_BITS) if place // WORD_BITS == w else 0).cast("bigint").alias(f"_{w}")
            for w in words
        ]
        entry = F.struct(F.lit(kind).alias("kind"), text.alias("value"), *mask)
        by_table.setdefault(name, []).append(entry)
    masks = [f"_{w}" for w in words]
    entries = None
    for name, own in by_table.items():
        part = tables[name].select(F.inline(F.array(*own))).filter(F.col("value").isNotNull())
        entries = part if entries is None else entries.unionByName(part)
    sets = entries.groupBy("kind", "value").agg(*[F.bit_or(m).alias(m) for m in masks])
    held = [
        F.when(F.col(f"_{i // WORD_BITS}").bitwiseAND(F.lit(1 << (i % WORD_BITS)).cast("bigint")) != 0, F.lit(f"{t}.{c}"))
        for i, (t, c) in enumerate(columns)
    ]
    members = sets.groupBy(*masks).count().select(F.array_compact(F.array(*held)).alias("_in"), "count")
    pairs = (
        members.select(F.explode("_in").alias("child"), "_in", "count")
        .select("child", F.explode("_in").alias("parent"), "count")
        .groupBy("child", "parent")
        .agg(F.sum("count").alias("shared_values"))
    )
    # A window has a row per column at most.
    own = F.max(F.when(F.col("child") == F.col("parent"), F.col("shared_values")))
    return (
        pairs.withColumn("child_values", own.over(Window.partitionBy("child")))
        .filter("child <> parent")
        .filter(F.col("shared_values") >= F.lit(least) * F.col("child_values"))
        .select("child", "parent", "child_values", "shared_values")
    )


def _comparable(kind: DataType, value: Column) -> tuple[str, Column]:
    """A name that comparable types share, and the value as text."""
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return "whole number", value.cast("string")
    if isinstance(kind, (FloatType, DoubleType)):
        return kind.simpleString(), (value + F.lit(0).cast(kind)).cast("string")  # one zero
    if isinstance(kind, BinaryType):
        return "binary", F.hex(value)
    if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
        raise ValueError(f"no values of type {kind.simpleString()} are compared")
    return kind.simpleString(), value.cast("string")
