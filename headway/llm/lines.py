"""Fuzzy line deduplication by MinHash, with DataFrame functions only.

A line is the set of its shingles of `CHARACTERS` characters, one at every character. The
signature is the minimum of each of `MINIMA` hashes of them. Equal lines collapse in the same
aggregation, known by two 64-bit hashes, so no text is shuffled for it. A band is three of
the minima: every three in a row, and some that lie a third of them apart, so that two bands
share at most one. Three keep unlike lines apart, of which two would let pairs meet by the
square of their number. Lines that agree in a band are candidates: each is compared with
the first line of the band, best supported candidates first, then with every line that
shares `SUPPORT` bands with it and is still in another component. A pair is linked if the
Jaccard similarity of the two sets, with shingles known by 64-bit hashes, is at least `ALIKE`,
or that of their shingles at words is at least `SIMILARITY`: every word opens one of `SHINGLE`
characters, which runs on into the words after it, or is one if it is longer; in scripts
without spaces the next character does, too.
Pairs that cannot be linked are told by odd sketches before any text is fetched for them: the
bit of every shingle is flipped, so two sketches differ in no more bits than the sets in shingles.
One line of each component is kept, the first of the corpus.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.common import few, free_name, keep
from headway.llm.components import components, labelled, merged
from headway.llm.ordering import with_order
from headway.llm.sieve import sifted

CHARACTERS = 8
ALIKE = 0.8
SHINGLE = 10
MINIMA = 24
ROWS = 3
BANDS = 12
SIMILARITY = 0.7
SUPPORT = 2  # bands that lines of different components must share to be compared
TOGETHER = 8  # shingles that one row has while they are signed or sketched
CHUNK = 2000  # lines of a band that meet in one group
WORDS = (8, 4)  # words of 64 bits in the sketches of all shingles and of those at words
SKETCH = [f"{kind}{i}" for kind, n in zip("es", WORDS) for i in range(n)]
KNOWN = ["n_every", "n_spaced", *SKETCH]
BAND = [f"band{i}" for i in range(BANDS)]
LAST = (1 << 63) - 1
# scripts that are written without spaces, fixed ranges of Unicode blocks
UNSPACED = "\\u3040-\\u30ff\\u3400-\\u9fff\\uac00-\\ud7af"
SPACED = f"(?s)(?:^|\\s)(?=(\\S{{{SHINGLE},}}|\\S.{{0,{SHINGLE - 1}}}))"
MIXED = f"(?s)(?:^|[\\s{UNSPACED}])(?=([^\\s{UNSPACED}]{{{SHINGLE},}}|\\S.{{0,{SHINGLE - 1}}}))"


def occurrences(documents: DataFrame) -> DataFrame:
    """doc, place, line and its two hashes, for every line with a visible character."""
    lines = documents.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.posexplode(F.split("text", "\n", -1)).alias("place", "line")
    )
    return lines.filter(F.col("line").rlike(r"\S")).select(
        "doc", "place", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    )


def shingles(line: str) -> Column:
    every = [F.regexp_extract_all(line, F.lit(p), F.lit(1)) for p in (MIXED, SPACED)]
    # the shorter pattern takes half the time
    return F.when(F.col(line).rlike(f"[{UNSPACED}]"), every[0]).otherwise(every[1])


def last(code: Column) -> Column:
    """The byte from which the last shingle of a line of UTF-32 is; a shorter line is one."""
    return F.greatest(F.lit(1), F.octet_length(code) - (4 * CHARACTERS - 1))


def window(code: Column, at: Column) -> Column:
    """The shingle from the byte `at` on, counted from 1."""
    # bytes of a fixed width, so that a place is reached without a walk through the line
    return F.substring(code, at, F.lit(4 * CHARACTERS))


def coded(line: str) -> Column:
    """The hashes of all shingles of a line, as often as they are there."""
    # held by a variable, as a row would copy all bytes each time it is asked for them
    one = F.transform(
        F.array(F.encode(line, "UTF-32")),
        lambda code: F.transform(F.sequence(F.lit(1), last(code), F.lit(4)), lambda at: F.xxhash64(window(code, at))),
    )
    return F.flatten(one)


def signed(documents: DataFrame) -> DataFrame:
    """One row per distinct line: hashes, a document that has it, minima `m0`, `m1`, ..."""
    own = occurrences(documents).select("doc", "h1", "h2", F.encode("line", "UTF-32").alias("code"))
    own = own.select("doc", "h1", "h2", "code", last(F.col("code")).alias("last"))
    # a row is `TOGETHER` shingles, the last ones as often as fill it, which no minimum shows:
    # the row of the aggregation is found and written once for all of them
    starts = F.sequence(F.lit(1), F.col("last"), F.lit(4 * TOGETHER))
    marked = own.select("doc", "h1", "h2", "code", "last", F.explode(starts).alias("at"))
    taken = [window(F.col("code"), F.least(F.col("at") + 4 * i, F.col("last"))) for i in range(TOGETHER)]
    codes = [f"shingle{i}" for i in range(TOGETHER)]
    marked = marked.select("doc", "h1", "h2", *(F.hash(w).alias(c) for w, c in zip(taken, codes)))
    # the element nearest to a random number by exclusive or is a fair draw from the set;
    # multiples of the golden ratio spread those numbers over all 32 bits
    draws = [(i * 0x9E3779B1 + 0x7F4A7C15) % (1 << 32) - (1 << 31) for i in range(MINIMA)]
    nearest = [F.least(*(F.col(c).bitwiseXOR(F.lit(d)) for c in codes)) for d in draws]
    minima = [F.min(c).alias(f"m{i}") for i, c in enumerate(nearest)]
    # numbers only, so that rows are aggregated by hash and not by sorting
    return marked.groupBy("h1", "h2").agg(F.min("doc").alias("doc"), *minima)


def banded(signed: DataFrame) -> DataFrame:
    """The lines with `bands`, a hash of each band, in place of the minima."""
    step = MINIMA // ROWS
    near = [range(at, at + ROWS) for at in range(0, MINIMA, ROWS)]
    far = [range(at, MINIMA, step) for at in range(step)]
    chosen = [*near, *far][:BANDS]
    bands = [F.xxhash64(F.lit(b), *(f"m{i}" for i in band)) for b, band in enumerate(chosen)]
    return signed.select("h1", "h2", "doc", F.array(*bands).alias("bands"))


def texts_of(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """id and line of the asked lines (id, h1, h2); other lines are not shuffled, or few."""
    own = sifted(occurrences(documents).select("h1", "h2", "line"), asked, ["h1", "h2"])
    # a line that very many documents have is one row of each task
    own = own.groupBy("h1", "h2").agg(F.first("line").alias("line"))
    return asked.join(own, ["h1", "h2"]).select("id", "line")


def similar(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b), read from a kept table, whose lines are similar enough."""
    # only lines that some pair has are shuffled, or few others
    ends = [texts.select(F.col("id").alias(end), F.col("line").alias(f"line_{end}")) for end in ("a", "b")]
    left, right = (sifted(own, pairs.select(end), [end]) for end, own in zip("ab", ends))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    every = [coded(c) for c in ("line_a", "line_b")]
    by_word = [shingles(c) for c in ("line_a", "line_b")]
    # most links are links by the fewer shingles, and then the others are not made
    return both.filter(reached(*by_word, SIMILARITY) | reached(*every, ALIKE)).select("a", "b")


def reached(left: Column, right: Column, share: float) -> Column:
    """Whether the Jaccard similarity of two arrays, as sets, is at least `share`."""
    sets = F.struct(F.array_distinct(left).alias("a"), F.array_distinct(right).alias("b"))

    def enough(both: Column) -> Column:
        return (1 + share) * F.size(F.array_intersect(both.a, both.b)) >= share * (F.size(both.a) + F.size(both.b))

    # the variable of a function holds the sets, or every use of one would extract it again
    return F.exists(F.array(sets), enough)


def sketched(texts: DataFrame) -> DataFrame:
    """id, the sizes of the two sets of each line and their sketches."""
    spaced = F.transform(F.array_distinct(shingles("line")), lambda s: F.xxhash64(s))
    own = texts.select("id", F.array_distinct(coded("line")).alias("every"), spaced.alias("spaced"))
    own = own.select("id", F.size("every").alias("n"), F.concat("every", "spaced").alias("codes"))
    own = own.select("id", "n", "codes", F.size("codes").alias("all"))
    marked = own.select("*", F.explode(F.sequence(F.lit(0), F.col("all") - 1, F.lit(TOGETHER))).alias("at"))
    words, bits = [], []
    for i in range(TOGETHER):
        # beyond the end there is none, and no word
        code, of_every = F.get("codes", F.col("at") + i), F.col("at") + i < F.col("n")
        turn = F.shiftright(code, 6)
        word = F.when(of_every, F.pmod(turn, F.lit(WORDS[0]))).otherwise(F.pmod(turn, F.lit(WORDS[1])) + WORDS[0])
        words.append(F.coalesce(word.cast("int"), F.lit(-1)).alias(f"word{i}"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), code.bitwiseAND(63).cast("int"))
        bits.append(F.coalesce(bit, F.lit(0).cast("long")).alias(f"bit{i}"))
    marked = marked.select("id", "n", "all", *words, *bits)
    odd = []
    for w, c in enumerate(SKETCH):
        own = [F.when(F.col(f"word{i}") == w, F.col(f"bit{i}")).otherwise(F.lit(0)) for i in range(TOGETHER)]
        odd.append(F.bit_xor(reduce(Column.bitwiseXOR, own)).alias(c))
    sizes = [F.max("n").alias("n_every"), (F.max("all") - F.max("n")).alias("n_spaced")]
    return marked.groupBy("id").agg(*sizes, *odd)


def known(sketches: DataFrame, end: str) -> DataFrame:
    return sketches.select(F.col("id").alias(end), *(F.col(c).alias(f"{end}_{c}") for c in KNOWN))


def differing(columns: list[str], size: str) -> tuple[Column, Column]:
    """The least number of shingles that a pair with what is known of both ends has not in
    common, and the number in both sets together."""
    bits = [F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in columns]
    a, b = F.col(f"a_{size}"), F.col(f"b_{size}")
    return F.greatest(sum(bits[1:], bits[0]).cast("long"), F.abs(a - b).cast("long")), a + b


MEASURES = [(SKETCH[: WORDS[0]], "n_every", ALIKE), (SKETCH[WORDS[0] :], "n_spaced", SIMILARITY)]


def near() -> Column:
    """Whether the sketches of a pair with what is known of both ends allow a link."""

    def allows(columns: list[str], size: str, share: float) -> Column:
        differ, both = differing(columns, size)
        # with d shingles apart and n in both sets together, similarity is (n - d) / (n + d)
        return (1 + share) * differ <= (1 - share) * both + 1e-6

    return reduce(Column.__or__, (allows(*m) for m in MEASURES))


def closeness() -> Column:
    """In thousandths, how far a pair is from what its sketches would exclude."""

    def room(columns: list[str], size: str, share: float) -> Column:
        differ, both = differing(columns, size)
        return 1 - (1 + share) * differ / ((1 - share) * F.greatest(both, F.lit(1)))

    return (F.greatest(*(room(*m) for m in MEASURES)) * 1000).cast("long")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components, the larger one as `of_a`."""
    found = labelled(labelled(pairs.drop("of_a", "of_b"), "a", labels, "at_a"), "b", labels, "at_b")
    own = [F.greatest("at_a", "at_b").alias("of_a"), F.least("at_a", "at_b").alias("of_b")]
    return found.filter("at_a <> at_b").select(*(c for c in found.columns if c not in ("at_a", "at_b")), *own)


def bits_of(columns: list[Column]) -> Column:
    """A number with a bit for each column that holds, the first one lowest."""
    return reduce(Column.bitwiseOR, (F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)))


def pairs_of(dealt: DataFrame) -> DataFrame:
    """What is known of both ends of every pair of lines of different components that share
    `SUPPORT` bands, with their number, and that their sketches allow a link.

    Others are no rows, and a pair is one, in the first band that it shares: lines of a large
    group are told apart by their bits. `tried` is whether one line is the first of a band
    they share.
    """
    group, ends = ["band", "one", "two"], []
    numbers = ["id", "component", "chunk", "first", *KNOWN, *BAND]
    at = bits_of([F.col(c) == F.col("band") for c in BAND]).alias("at")
    # Spark takes numbers of files for possibly null, and with code for that the method that
    # compares a pair would grow beyond what the JVM compiles
    dealt = dealt.select(*group, at, *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers))
    for end in ("a", "b"):
        own = [F.col("id").alias(end), F.col("component").alias(f"of_{end}"), F.col("chunk").alias(f"in_{end}")]
        # the same columns on both sides, so that they are shuffled once
        ends.append(dealt.select(*group, *own, *(F.col(c).alias(f"{end}_{c}") for c in ["at", "first", *KNOWN, *BAND])))
    # two lines of one chunk meet where the chunk meets itself
    met = ends[0].join(ends[1], group).filter("of_a > of_b and (one = two or in_a <> in_b)")
    shared = bits_of([F.col(f"a_{c}") == F.col(f"b_{c}") for c in BAND])
    at = F.col("a_at").bitwiseAND(F.col("b_at"))
    met = met.filter((F.bit_count(shared) >= SUPPORT) & (shared.bitwiseAND(at - 1) == 0) & near())
    tried = F.col("a_first").bitwiseOR(F.col("b_first")).bitwiseAND(shared) != 0
    return met.withColumn("support", F.bit_count(shared).cast("long")).withColumn("tried", tried)


def meeting(dealt: DataFrame) -> DataFrame:
    return pairs_of(dealt).select("a", "b", "of_a", "of_b", "support", "tried", closeness().alias("close"))


def closest(cross: DataFrame) -> DataFrame:
    """Of each component the pair with one of a smaller label that most likely is a link."""
    key = F.col("close") * (1 << 48) + F.xxhash64("a", "b").bitwiseAND((1 << 48) - 1)
    # numbers only, so that rows are aggregated by hash; two pairs of one key could at most
    # lend an end each to a pair that is compared as any other
    best = cross.select(F.greatest("of_a", "of_b").alias("of"), "a", "b", key.alias("key")).groupBy("of")
    return best.agg(F.max_by("a", "key").alias("a"), F.max_by("b", "key").alias("b")).select("a", "b")


def opened(placed: DataFrame) -> DataFrame:
    """Bands with lines of several components, and their number of lines."""
    found = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")
    )
    return found.filter("low <> high").select("band", "n")


def open_members(placed: DataFrame, most: int) -> DataFrame:
    """Lines in `SUPPORT` bands with lines of other components, in those bands.

    Lines with fewer share too few with any of another component. Without them more bands
    hold a single component, so it is done again.
    """
    for _ in range(2):
        bands = keep(few(opened(placed).select("band"), most), "open")
        left = keep(few(placed.join(bands, "band"), most), "open-members")
        several = left.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT).select("id")
        several = keep(few(several, most), "open-ids")
        placed = keep(few(left.join(several, "id").select(*placed.columns), most), "open-members")
    return placed


def crossing(members: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """Every pair (a, b) that shares `SUPPORT` bands, may be linked, was not compared with the
    first line of a band and whose ends are in different components, `of_a` and `of_b`.

    Lines of a similarity of 0.8 share them with a chance of 99.7 %, most that only have a
    passage in common do not. A band of many lines is dealt into chunks, and each pair of
    chunks is a group of its own.
    """
    most = members.count()
    placed = open_members(keep(few(labelled(members, "id", labels, "component"), most), "placed"), most)
    open_ = opened(placed).select("band", F.ceil(F.col("n") / CHUNK).alias("chunks"))
    open_ = keep(few(open_, most), "open")
    dealt = placed.join(open_, "band").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    known = ["first", *KNOWN, *BAND]
    dealt = dealt.join(sketches, "id").select("band", "id", "component", "chunk", other, *known).select(
        "band", "id", "component", "chunk", *known,
        F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"),
    )
    return meeting(keep(dealt, "dealt")).filter("not tried").drop("tried")


def settled(cross: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """`labels` with the components joined that links among the pairs `cross` join.

    The pairs of a large group grow with its square. As long as a tenth of them are links, only
    the closest pair of each component is compared: most pairs are within one component then,
    and need not be. All that are left are compared.
    """
    while not cross.isEmpty():
        asked = keep(closest(cross), "closest")
        links = keep(similar(texts, asked), "line-links")
        joined, compared = links.count(), asked.count()
        if joined:
            labels = merged(labels, links)
        cross = keep(apart(cross.join(asked, ["a", "b"], "left_anti"), labels), "line-crossing")
        if 10 * joined <= compared:
            break
    # of two components the closest pair, then what is apart even so
    key = F.struct("close", "support", "a", "b")
    best = cross.groupBy("of_a", "of_b").agg(F.max_by(F.struct("a", "b"), key).alias("best"))
    best = keep(best.select("best.a", "best.b"), "line-crossing")
    if not best.isEmpty():
        links = keep(similar(texts, best), "line-links")
        cross = cross.join(best, ["a", "b"], "left_anti")
        if not links.isEmpty():
            labels = merged(labels, links)
            cross = apart(cross, labels)
        cross = keep(cross, "line-crossing")
    if not cross.isEmpty():
        labels = merged(labels, keep(similar(texts, cross), "line-links"))
    return labels


def line_components(documents: DataFrame) -> DataFrame:
    """h1, h2, the first document, and `component` of every distinct line."""
    lines = keep(banded(signed(documents)).withColumn("id", F.monotonically_increasing_id()), "lines")
    bands = lines.select("id", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("id").alias("b"), F.count("*").alias("n"))
    shared = keep(shared.filter("n > 1").drop("n"), "bands")
    # both sides of the join come from files, so Spark can split a band of many lines
    members = keep(sifted(bands, shared, ["band"]).join(shared, "band"), "band-members")
    pairs = members.filter("id <> b").groupBy(F.col("id").alias("a"), "b")
    pairs = keep(pairs.agg(F.count("*").alias("support")), "line-pairs")
    most = members.count()
    # the bands whose first line a line is: it is compared with all others of them
    met = members.groupBy("id").agg(F.collect_set(F.when(F.col("id") == F.col("b"), F.col("band"))).alias("leads"))
    met = keep(few(met, most), "line-met")
    ids = lines.select("id", "h1", "h2", *(F.col("bands")[i].alias(c) for i, c in enumerate(BAND)))
    leads = bits_of([F.array_contains("leads", F.col(c)) for c in BAND])
    ids = sifted(ids, met, ["id"]).join(met, "id").withColumn("first", leads).drop("leads")
    ids = keep(ids, "line-ids")
    texts = keep(texts_of(documents, ids.select("id", "h1", "h2")), "line-texts")
    sketches = keep(sketched(texts).join(ids.select("id", "first", *BAND), "id"), "line-sketches")
    for end in ("a", "b"):
        pairs = pairs.join(known(sketches, end), end)
    pairs = keep(pairs.filter(near()).select("a", "b", "support"), "line-near")
    best = keep(few(pairs.groupBy("a").agg(F.max_by("b", F.struct("support", "b")).alias("b")), most), "best")
    labels = components(keep(similar(texts, best), "line-links"))
    rest = keep(few(apart(pairs.join(best, ["a", "b"], "left_anti"), labels).select("a", "b"), most), "line-rest")
    if not rest.isEmpty():
        labels = merged(labels, keep(similar(texts, rest), "line-links"))
    cross = keep(crossing(members.select("band", "id"), labels, sketches), "line-crossing")
    labels = settled(cross, labels, texts)
    return labelled(lines.select("id", "h1", "h2", "doc"), "id", labels, "component")


def verdicts(documents: DataFrame) -> DataFrame:
    """doc, place, component, keeper and kept of every line with a visible character.

    `keeper` is the document that keeps a line of the component. `component` is the same for
    all lines that go together, and for the same lines in every run. Rows that repeat a
    doc_id share their verdicts where their lines are equal; rows without an id come last.
    """
    found = line_components(documents)
    first = found.groupBy("component").agg(F.min("doc").alias("keeper"), F.min("h1").alias("name"))
    by_line = keep(found.join(first, "component").select("h1", "h2", "component", "name", "keeper"), "line-verdicts")
    own = occurrences(documents).select("doc", "place", "h1", "h2")
    own = own.join(by_line, ["h1", "h2"]).select("doc", "place", "component", "name", "keeper").repartition("doc")
    # the first document that has the component keeps its first line of it
    first = F.min("place").over(Window.partitionBy("doc", "component"))
    return own.withColumn("first", first).select(
        "doc", "place", F.col("name").alias("component"), "keeper",
        ((F.col("doc") == F.col("keeper")) & (F.col("place") == F.col("first"))).alias("kept"),
    )


def summaries(documents: DataFrame) -> DataFrame:
    """Lines with a visible character, dropped ones and their places, per document with any.

    `classes` has the component of each of these lines and the document that keeps one of it:
    there the line kept is the first with that component.

    A null text has no lines, as has an empty one: those documents give no row, nor does an
    empty table. Other columns are not read.
    """
    found = verdicts(documents.select("doc_id", "text"))
    return found.groupBy("doc").agg(
        F.count("*").alias("n_lines"),
        F.count_if(~F.col("kept")).alias("n_dropped"),
        F.array_sort(F.collect_set(F.when(~F.col("kept"), F.col("place")))).alias("dropped"),
        # rows that repeat a doc_id have one class for each of their texts' lines
        F.array_sort(F.collect_set(F.struct(
            "place", "component", F.nullif("keeper", F.lit(LAST)).alias("keeper"), "kept"
        ))).alias("classes"),
    ).select(F.nullif("doc", F.lit(LAST)).alias("doc_id"), "n_lines", "n_dropped", "dropped", "classes")


def without_repeated_lines(documents: DataFrame) -> DataFrame:
    """The documents without the lines dropped, and `n_chars` set to what is left.

    Blank lines stay. A document that loses all its lines with a visible character goes.
    Rows that repeat a doc_id and its text are one document; other texts of a repeated id,
    and rows without an id, which come last, are documents of their own.
    """
    names = documents.columns
    key, lost = free_name(documents, "line_doc"), free_name(documents, "lost_lines")
    numbered = with_order(documents, key)
    drops = verdicts(numbered.select(F.col(key).alias("doc_id"), "text")).filter("not kept").groupBy(
        F.col("doc").alias(key)
    ).agg(F.collect_set("place").alias(lost))
    found = numbered.join(drops, key, "left")
    left = F.array_join(
        F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(lost, i)), "\n"
    )
    found = found.withColumn("text", F.when(F.col(lost).isNull(), F.col("text")).otherwise(left))
    found = found.filter(F.col(lost).isNull() | F.col("text").rlike(r"\S"))
    if "n_chars" in names:
        found = found.withColumn("n_chars", F.length("text").cast("long"))
    return found.select(*names)
