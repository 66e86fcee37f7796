"""Benchmark decontamination with built-in functions only.

The windows of all test items, normalised, go into a hash set: an array of
64-bit words that every task gets as the value of a scalar subquery. Its size
follows the counted windows, at least :data:`BITS_PER_WINDOW` bits for each, so
that fewer than one window in a hundred passes without being a test window. A
set never exceeds :data:`MAX_BITS`; a benchmark that does not fit is dealt by
hash over several sets of that size, each with a scan of its own. Documents are
split into words once a scan and every window of theirs is probed where it
stands. Candidates carry their words and are verified by an exact join with the
test windows, so hash collisions have no effect. Hits mark words, and documents
or marked words can then be removed.

Defined results: a null text has no words; an item without words has no windows;
an item of fewer than ``size`` words is one window; repeated items count once by
id; an item without id marks words but is not listed; repeated documents get
rows of their own; an empty benchmark marks nothing; the digest of no items is
that of the empty text. A removed word takes the separators in front of it along;
a text without marked words comes back as it was, a null as null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from regua.llm.common import ascii_lower, store, unused

SIZE = 10
#: Sizes of a hash set are powers of two between these (512 KiB and 8 MiB).
MIN_BITS, MAX_BITS = 1 << 22, 1 << 26
#: With four probes, 12 bits a window let 0.65 % of other windows through.
BITS_PER_WINDOW, PROBES = 12, 4
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of a text as it is written, with the separators in front of it, or what follows the last word.
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*+(?:[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++|\z)"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_A_WORD)
    return F.filter(parts, lambda w: w != "")


def _gram(ws: Column, at: Column, size: int) -> list[Column]:
    return [F.get(ws, at + k) for k in range(size)]


def set_bits(n_windows: int, largest: int = MAX_BITS) -> tuple[int, int]:
    """Bits of a hash set for so many windows, and how many such sets they need."""
    sets = max(1, -(-n_windows * BITS_PER_WINDOW // largest))
    each = -(-n_windows // sets) * BITS_PER_WINDOW
    return min(largest, max(MIN_BITS, 1 << (max(each, 1) - 1).bit_length())), sets


def _places(code: Column, bits: int) -> list[Column]:
    """The bits of a hash set that stand for a code: two halves, stepped through."""
    low = code.bitwiseAND(F.lit(0xFFFFFFFF))
    step = F.shiftrightunsigned(code, 32).bitwiseOR(F.lit(1).cast("long"))
    mask = F.lit(bits - 1).cast("long")
    return [(low + step * k if k else low).bitwiseAND(mask) for k in range(PROBES)]


def item_windows(benchmark: DataFrame, size: int, item_id: str, text: str) -> DataFrame:
    """(item_id as text, n, gram) for each distinct window of each item."""
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item_id"), words(F.col(text)).alias("ws")
    ).where(F.size("ws") > 0)
    n = F.least(F.size("ws"), F.lit(size))
    starts = F.sequence(F.lit(0), F.size("ws") - n)
    grams = F.transform(starts, lambda at: F.concat_ws(" ", F.slice("ws", at + 1, n)))
    return items.select("item_id", n.alias("n"), F.explode(grams).alias("gram")).distinct()


def hash_set(codes: DataFrame, bits: int) -> DataFrame:
    """One row: the bits of all values of ``code`` as an array ``held`` of ``bits`` / 64 longs."""
    places = codes.select(F.explode(F.array(*_places(F.col("code"), bits))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    held = places.groupBy(F.shiftright("place", 6).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits"))
    # At most MAX_BITS / 64 rows meet here, whatever the benchmark holds.
    every = codes.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("at"))
    filled = every.join(held, "at", "left").select(
        "at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")
    )
    ordered = F.array_sort(F.collect_list(F.struct("at", "bits")))
    return filled.agg(F.transform(ordered, lambda x: x["bits"]).alias("held"))


def _probe(held: Column, code: Column, bits: int) -> Column:
    inside = [
        F.bit_get(F.get(held, F.shiftright(place, 6).cast("int")), (place % 64).cast("int")) == 1
        for place in _places(code, bits)
    ]
    return reduce(Column.__and__, inside)


def _found(ws: Column, held: Column, n: int, bits: int) -> Column:
    """The windows of ``n`` words that the hash set lets through."""
    last = F.size(ws) - n
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )
    # The code is held by a struct, so it is made once for each window and not once a probe.
    coded = F.transform(starts, lambda at: F.struct(at.alias("at"), F.xxhash64(*_gram(ws, at, n)).alias("code")))
    near = F.filter(coded, lambda x: _probe(held, x["code"], bits))
    return F.transform(
        near,
        lambda x: F.struct(
            x["at"].alias("at"), F.lit(n).alias("n"), F.concat_ws(" ", *_gram(ws, x["at"], n)).alias("gram")
        ),
    )


def counted(windows: DataFrame) -> dict[int, int]:
    """Distinct windows by their number of words, at most SIZE numbers."""
    return {r.n: r.c for r in windows.groupBy("n").agg(F.countDistinct("gram").alias("c")).collect()}


def candidates(
    docs: DataFrame, windows: DataFrame, bits: dict[int, int], text: str, n_words: str, found: str
) -> DataFrame:
    """``docs`` with its number of words and the windows that the hash sets let through: (at, n, gram).

    ``bits`` gives the size of the set for each number of words.
    """
    sizes = sorted(bits)
    probe_sets = {}
    for n in sizes:
        grams = windows.where(F.col("n") == n).select("gram").distinct()
        parts = F.split("gram", " ")
        code = F.xxhash64(*[F.get(parts, k) for k in range(n)])
        probe_sets[n] = hash_set(grams.select(code.alias("code")), bits[n]).scalar()
    names = {n: unused(docs, f"held_{n}") for n in sizes}

    def scan(bound: Column) -> Column:
        # The words are bound to a lambda variable, so they are made once for each text.
        ws = bound["ws"]
        hits = [_found(ws, bound[names[n]], n, bits[n]) for n in sizes]
        empty = F.array().cast("array<struct<at:int,n:int,gram:string>>")
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            (F.concat(*hits) if hits else empty).alias("found"),
        )

    # The subqueries are named a step before, since functions with lambdas take none directly.
    held = docs.withColumns({names[n]: probe_sets[n] for n in sizes})
    bound = F.struct(words(F.col(text)).alias("ws"), *(F.col(names[n]) for n in sizes))
    whole = F.transform(F.array(bound), scan)[0]
    kept = unused(docs, "scanned")
    return held.withColumn(kept, whole).select(
        *docs.columns, F.col(kept)["n_words"].alias(n_words), F.col(kept)["found"].alias(found)
    )


def scanned(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str,
    row: str,
    n_words: str,
    *,
    keep_text: bool = True,
    max_bits: int = MAX_BITS,
) -> tuple[DataFrame, DataFrame]:
    """``docs`` numbered by ``row`` with ``n_words``, stored, and what is verified of each row with a hit."""
    windows = store(item_windows(benchmark, SIZE, "item_id", "text"), "windows")
    plan = {n: set_bits(c, max_bits) for n, c in counted(windows).items()}
    bits = {n: own for n, (own, _) in plan.items()}
    passes = max((sets for _, sets in plan.values()), default=1)
    found = unused(docs, "found")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    if passes > 1:
        # Every scan has to meet the same numbers.
        numbered = store(numbered, "numbered")
    near, rest = [], docs
    for at in range(passes):
        own = windows if passes == 1 else windows.where(F.pmod(F.hash("gram"), F.lit(passes)) == at)
        step = candidates(numbered, own, bits, text, n_words, found)
        if at:
            step = step.where(F.size(found) > 0).select(row, found)
        staged = store(step if keep_text or at else step.drop(text), "scanned")
        rest = rest if at else staged.drop(found)
        near.append(staged.where(F.size(found) > 0).select(F.col(row).alias("r"), F.inline(found)))
    return rest, verified(reduce(DataFrame.unionByName, near), windows, row)


def verified(near: DataFrame, windows: DataFrame, row: str) -> DataFrame:
    """(row, marked, items): the marked words and the items of each document that holds a test window."""
    hits = store(near.join(windows.select("gram").distinct(), "gram", "left_semi"), "hits")
    # A word is marked once, however many windows cover it.
    covered = F.flatten(
        F.transform(F.collect_list(F.struct("at", "n")), lambda x: F.sequence(x["at"], x["at"] + x["n"] - 1))
    )
    marked = hits.groupBy("r").agg(F.array_distinct(covered).alias("marked"))
    items = (
        hits.select("r", "gram").distinct().join(windows.where("item_id is not null").select("gram", "item_id"), "gram")
        .select("r", "item_id")
        .distinct()
        .groupBy("r")
        .agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )
    return marked.join(items, "r", "left").select(
        F.col("r").alias(row), "marked", F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    staged, found = scanned(docs.select("doc_id", "text"), benchmark, "text", "row", "n_words", keep_text=False)
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(F.size("marked"), F.lit(0)).cast("long")
    return staged.select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any test window, with all their columns."""
    row = unused(docs, "row_number")
    staged, found = scanned(docs, benchmark, text, row, unused(docs, "n_words"))
    return staged.join(found.select(row).hint("merge"), row, "left_anti").select(docs.columns)


def remove_marked_words(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """All rows of ``docs``, their texts without the words that test windows cover."""
    row, marked = unused(docs, "row_number"), unused(docs, "marked")
    staged, found = scanned(docs, benchmark, text, row, unused(docs, "n_words"))

    def rest(bound: Column) -> Column:
        # Bound to a lambda variable, so a text is cut once and not once a word.
        every = F.sequence(F.lit(0), F.size(bound["pieces"]) - 1)
        return F.array_join(F.transform(F.array_except(every, bound["marked"]), lambda at: F.get(bound["pieces"], at)), "")

    cut = F.regexp_extract_all(F.col(text), F.lit(PIECE), F.lit(0))
    bound = F.struct(cut.alias("pieces"), F.col(marked).alias("marked"))
    return staged.join(
        found.select(row, F.col("marked").alias(marked)).hint("merge"), row, "left"
    ).withColumn(
        text, F.when(F.col(marked).isNull(), F.col(text)).otherwise(F.transform(F.array(bound), rest)[0])
    ).select(docs.columns)
