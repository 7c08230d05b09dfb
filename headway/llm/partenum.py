"""Exact Jaccard self-join on word n-grams by PartEnum signatures.

Sizes fall into overlapping bands, so that two sets of a Jaccard similarity of at least
`share` percent lie in one band together. The largest size of a band bounds how many
features may differ, say k. The features' domain is cut by their hash into n1 groups of n2
partitions. In one group at most k2 = n2 - 1 (or fewer, as given) features differ, so there
is a subset of n2 - k2 partitions of that group in which both sets are equal: the hash of
each subset's features is a signature. Subsets without features are no signatures. A set
with so many of them that this could cost the only shared signature adds signatures of a
finer cut, and last its features one by one, so no pair is lost.

Documents with equal sets are one class, known by the sum of their features' hashes. In a
task, equal signatures of a block are joined to the smallest id first, and only that one
goes on, so a signature that many documents share is a few rows of the shuffle. Candidate
pairs are verified on the texts: first every document with the candidate it shares most
signatures with, then pairs whose ends are still apart, then whatever else shares enough
signatures across components. Sizes and the number of shared signatures rule out most pairs
before. So does an odd sketch of each set: the bit of every feature is flipped, so two sketches
differ in no more bits than the sets in features, and a pair whose sketches differ in more than
the similarity allows is none. What is left apart shares no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.common import SpanHash, blocks, by_rows, keep, mixed, utf8, words
from headway.llm.components import components, labelled
from headway.llm.sieve import sifted

PARTITIONS = 2  # n2
SUBSET_GAP = 1  # k2
BAND = 1.35  # ratio of the lower ends of bands
SKETCH = [f"sketch{i}" for i in range(8)]  # words of 64 bits
SETS = "doc_id long, n_shingles long, first long, second long, differ long, asks long, " + ", ".join(
    f"{c} long" for c in SKETCH
)


def shingles(data: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct n-gram of lower-cased words, by row and hash.

    A text of fewer words has one feature, all of them; one without words has none.
    """
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    # hashing words takes several numbers for each byte
    for first, end in by_rows(starts):
        part = data[starts[first] : starts[end]]
        row, code = slice_shingles(part, starts[first : end + 1] - starts[first], n)
        rows.append(row + first)
        found.append(code)
    return np.concatenate(rows), np.concatenate(found)


def slice_shingles(data: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    data = fold[data]
    begin, end, row = words(data, starts)
    word = SpanHash(data).of(begin, end)
    grams, rows = [], []
    total = np.bincount(row, minlength=len(starts) - 1)
    for size in range(1, n + 1):
        if len(word) < size:
            break
        whole = row[size - 1 :] == row[: len(row) - size + 1]
        if size < n:
            whole &= total[row[size - 1 :]] == size
        at = np.flatnonzero(whole)
        code = np.full(len(at), size, np.uint64)
        for i in range(size):
            code = mixed(code * np.uint64(0x9E3779B97F4A7C15) + word[at + i])
        grams.append(code)
        rows.append(row[at])
    if not grams:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    code, owner = np.concatenate(grams), np.concatenate(rows)
    order = np.argsort(code)
    order = order[np.argsort(owner[order].astype(np.int32), kind="stable")]
    code, owner = code[order], owner[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], code[new]


def bands(size: np.ndarray, share: int) -> list[tuple[np.ndarray, ...]]:
    """Members, band, its smallest size and its number of features that may differ: of each
    set's own band, and of those below that reach as far."""
    lower = [1]
    top = int(size.max(initial=1))
    while lower[-1] <= top:
        lower.append(max(lower[-1] + 1, int(lower[-1] * BAND)))
    low = np.array(lower)
    upper = (low[1:] - 1) * 100 // share
    differ = 2 * upper * (100 - share) // (100 + share)
    own = np.searchsorted(low, size, "right") - 1
    member, out = np.flatnonzero(size > 0), []
    band = own[member]
    while len(member):
        out.append((member, band, low[band], differ[band]))
        below = (band > 0) & (size[member] <= upper[band - 1])
        member, band = member[below], band[below] - 1
    return out


def asked(size: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each set, how many features may differ in its own band, and how many signatures it
    shares at least with any similar set.

    A set as large or larger shares the set's own band, a smaller one its own, which may be
    lower: the least over all of them holds for every partner.
    """
    own, asks = np.zeros(len(size), np.int64), np.full(len(size), np.iinfo(np.int64).max)
    largest = size * 100 // share
    for turn, (member, _, least, differ) in enumerate(bands(size, share)):
        if not turn:
            own[member] = differ
        both = size[member] + largest[member]
        asks[member] = np.minimum(asks[member], np.maximum(1, differ + 1 - both * (100 - share) // (100 + share)))
        # what has a lower band as its own is smaller than all of this one
        largest[member] = least - 1
    return own, asks


def groups_for(need: np.ndarray, least: np.ndarray, n2: int, k2: int) -> np.ndarray:
    """Enough groups above `need` for the weak ones that even the smallest sets of a band
    will likely have; more would only make partitions smaller."""
    groups = need + 1
    for _ in range(4):
        empty = np.exp(-least * (n2 - k2) / (groups * n2))
        weak = groups * n2 * empty
        groups = np.minimum(need + 1 + np.ceil(weak + 3 * np.sqrt(weak)), 2 * need + 2).astype(np.int64)
    return groups


def cut(
    code: np.ndarray, first: np.ndarray, size: np.ndarray, groups: np.ndarray, salt: np.ndarray, n2: int, k2: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of sets cut into `groups` x `n2` partitions: member, signature, and the
    number of weak groups of each member, those with an empty subset.

    Features are in order of their hash, and partitions are ranges of it.
    """
    owner = np.repeat(np.arange(len(size)), size)
    at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    mine = code[at]
    parts = groups * n2
    base = np.concatenate([[0], np.cumsum(parts)])
    part = ((mine >> np.uint64(32)) * parts[owner].astype(np.uint64)) >> np.uint64(32)
    flat = base[owner] + part.astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    sums = np.zeros(base[-1], np.uint64)
    held = np.zeros(base[-1], bool)
    if len(flat):
        sums[flat[edge]] = np.add.reduceat(mixed(mine + np.uint64(0xA5A5)), edge)
        held[flat[edge]] = True
    member = np.repeat(np.arange(len(size)), groups)
    place = np.arange(base[-1]) - np.repeat(base[:-1], parts)
    sums = mixed(sums ^ mixed(place.astype(np.uint64) + np.uint64(1))).reshape(-1, n2)
    held = held.reshape(-1, n2)
    weak = np.zeros(len(member), bool)
    members, found = [], []
    for chosen in combinations(range(n2), n2 - k2):
        some = held[:, chosen].any(axis=1)
        weak |= ~some
        total = sums[:, chosen].sum(axis=1, dtype=np.uint64)
        members.append(member[some])
        found.append(mixed(total[some] ^ salt[member[some]]))
    return np.concatenate(members), np.concatenate(found), np.bincount(member, weak, len(size)).astype(np.int64)


def signatures(
    row: np.ndarray, code: np.ndarray, n: int, share: int, n2: int = PARTITIONS, k2: int = SUBSET_GAP
) -> tuple[np.ndarray, np.ndarray]:
    """Row and signature of `n` sets given as rows and hashes in order."""
    first = np.searchsorted(row, np.arange(n))
    size = np.bincount(row, minlength=n)
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for member, band, least, differ in bands(size, share):
        need = differ // (k2 + 1) + 1
        for level in range(2):
            groups = 2 * need + 2 if level else groups_for(need, least, n2, k2)
            salt = mixed((band * 4 + level).astype(np.uint64) + np.uint64(0x5151))
            local, signature, weak = cut(code, first[member], size[member], groups, salt, n2, k2)
            rows.append(member[local])
            found.append(signature)
            # a pair shares groups - need + 1 groups at least; one of them must not be weak
            again = weak >= groups - need + 1
            member, band, least, need = member[again], band[again], least[again], need[again]
        owner = np.repeat(member, size[member])
        at = np.repeat(first[member] - np.concatenate([[0], np.cumsum(size[member])[:-1]]), size[member])
        at = at + np.arange(len(at))
        rows.append(owner)
        found.append(mixed(code[at] ^ mixed(np.repeat(band, size[member]).astype(np.uint64) + np.uint64(0x777))))
    return np.concatenate(rows), np.concatenate(found)


def sketches(code: np.ndarray, edge: np.ndarray) -> list[np.ndarray]:
    """By word, the bits that an odd number of each set's features fall on."""
    place = mixed(code ^ np.uint64(0x0DD))
    bit = np.uint64(1) << (place & np.uint64(63))
    word = (place >> np.uint64(6)) % np.uint64(len(SKETCH))
    found = []
    for i in range(len(SKETCH)):
        odd = np.zeros(len(code) + 1, np.uint64)
        np.bitwise_xor.accumulate(np.where(word == np.uint64(i), bit, np.uint64(0)), out=odd[1:])
        found.append((odd[edge[1:]] ^ odd[edge[:-1]]).view(np.int64))
    return found


def sets(documents: DataFrame, words_each: int, share: int) -> DataFrame:
    """Size of each document's set, two sums of its features' hashes, which name the set,
    what asked() says of it and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                row, code = shingles(*utf8(part.column("text")), words_each)
                edge = np.searchsorted(row, np.arange(part.num_rows + 1))
                total = [np.concatenate([[0], np.cumsum(mixed(code ^ np.uint64(s)))]).astype(np.uint64) for s in (3, 5)]
                differ, asks = asked(np.diff(edge), share)
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(np.diff(edge)),
                     *(pa.array((t[edge[1:]] - t[edge[:-1]]).view(np.int64)) for t in total),
                     pa.array(differ), pa.array(asks), *map(pa.array, sketches(code, edge))],
                    names=["doc_id", "n_shingles", "first", "second", "differ", "asks", *SKETCH],
                )

    return documents.select("doc_id", "text").mapInArrow(run, SETS)


def signed(documents: DataFrame, words_each: int, share: int) -> DataFrame:
    """(signature, id, rep): within a block, equal signatures point to their smallest id.

    That id itself has no rep. Signatures have 48 bits: a few more may meet by chance, which
    costs a comparison, and rows of the shuffle pack better.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                row, code = shingles(*utf8(part.column("text")), words_each)
                owner, signature = signatures(row, code, part.num_rows, share)
                signature = signature >> np.uint64(16)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)[owner].astype(np.int64)
                order = np.argsort(signature)
                ranked = signature[order]
                edge = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ids) else np.zeros(0, np.int64)
                rep = ids.copy()  # rows stay in the order of documents, which packs well
                if len(ids):
                    rep[order] = np.repeat(np.minimum.reduceat(ids[order], edge), np.diff(np.append(edge, len(ids))))
                yield pa.record_batch(
                    [pa.array(signature.view(np.int64)), pa.array(ids), pa.array(rep, mask=rep == ids)],
                    names=["signature", "id", "rep"],
                )

    known = documents.select("doc_id", "text").filter("doc_id is not null and text is not null")
    return known.mapInArrow(run, "signature long, id long, rep long")


def shared(signed: DataFrame) -> DataFrame:
    """Members of signatures that two ids have, each with the smallest id at hand.

    Rows that a task has joined already stay in a group of their own, so one row for each
    block meets the others of a signature.
    """
    group = Window.partitionBy("signature", "joined")
    met = signed.withColumn("joined", F.when(F.col("rep").isNotNull(), F.col("id")))
    least = F.coalesce(F.min("rep").over(group), F.min("id").over(group))
    met = met.withColumns({"least": least, "most": F.max("id").over(group)})
    met = met.filter("rep is not null or least <> most")
    return met.select("signature", "id", "least")


def compared(texts: DataFrame, pairs: DataFrame, words_each: int, share: int) -> DataFrame:
    """The pairs (a, b), read from a kept table, whose sets are similar enough, counted on the
    texts. Texts of no pair are not shuffled, or few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in blocks(batch, "text_b"):
                for part in blocks(half, "text_a"):
                    (ra, ca), (rb, cb) = (
                        shingles(*utf8(part.column(c)), words_each) for c in ("text_a", "text_b")
                    )
                    row, code = np.concatenate([ra, rb]), np.concatenate([ca, cb])
                    order = np.argsort(code)
                    order = order[np.argsort(row[order].astype(np.int32), kind="stable")]
                    row, code = row[order], code[order]
                    same = row[1:][(row[1:] == row[:-1]) & (code[1:] == code[:-1])]
                    common = np.bincount(same, minlength=part.num_rows)
                    union = np.bincount(row, minlength=part.num_rows) - common
                    ok = pa.array((union > 0) & (100 * common >= share * union))
                    yield part.select(["a", "b"]).filter(ok)

    ends = [texts.select(F.col("doc_id").alias(end), F.col("text").alias(f"text_{end}")) for end in ("a", "b")]
    left, right = (sifted(own, pairs.select(end), [end]) for end, own in zip("ab", ends))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def least_shared(differ: Column, sizes: Column, share: int) -> Column:
    """How many signatures two similar sets share at least, given their sizes together.

    Of the 2 n1 partitions of a cut, those of n1 - need weak groups may be empty, and each
    feature that differs takes one away; `differ` is what the band allows at most.
    """
    return F.greatest(F.lit(1), differ + 1 - F.floor(sizes * (100 - share) / (100 + share)))


def known(sizes: DataFrame, end: str) -> DataFrame:
    """What is known of the sets at one end of pairs."""
    names = ["least", "most", "differ", *SKETCH]
    return sizes.select(F.col("doc_id").alias(end), *(F.col(c).alias(f"{end}_{c}") for c in names))


def close(share: int) -> Column:
    """Whether sizes and sketches of a pair with what is known of both ends allow the similarity.

    An id with several texts has no sketch and passes.
    """
    fits = 100 * F.least("a_most", "b_most") >= share * F.greatest("a_least", "b_least")
    bits = [F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in SKETCH]
    differ = sum(bits[1:], bits[0])
    # with d features apart and n in both sets together, similarity is (n - d) / (n + d)
    near = differ * (100 + share) <= (F.col("a_most") + F.col("b_most")) * (100 - share)
    return fits & F.coalesce(near, F.lit(True))


def alike(pairs: DataFrame, sizes: DataFrame, share: int) -> DataFrame:
    """Pairs whose sizes, sketches and number of shared signatures, `support`, allow the similarity."""
    for end in ("a", "b"):
        pairs = pairs.join(known(sizes, end), end)
    enough = least_shared(F.least("a_differ", "b_differ"), F.col("a_most") + F.col("b_most"), share)
    return pairs.filter(close(share) & (F.col("support") >= enough)).select("a", "b", "support")


def viable(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members that meet others in as many signatures as any similar set would ask for, and
    a few more, which cost work but no link: so members need no shuffle by id."""
    counts = members.groupBy("id").agg(F.count("*").alias("met"))
    own = sizes.select(F.col("doc_id").alias("id"), "asks")
    ids = keep(counts.join(own, "id").filter("met >= asks").select("id"), "viable")
    return sifted(members, ids, ["id"])


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    found = labelled(labelled(pairs, "a", labels, "of_a"), "b", labels, "of_b")
    return found.filter("of_a <> of_b").drop("of_a", "of_b")


def unshared(texts: DataFrame, words_each: int) -> DataFrame:
    """id and `alone`, the number of its features that no other of the texts has.

    A feature that several texts of a block have is one row without an id, so one that
    very many share is a row for each block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                row, code = shingles(*utf8(part.column("text")), words_each)
                if not len(row):
                    continue
                ids = part.column("doc_id").to_numpy()[row]
                order = np.argsort(code)
                ids, code = ids[order], code[order]
                edge = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                several = np.minimum.reduceat(ids, edge) != np.maximum.reduceat(ids, edge)
                yield pa.record_batch(
                    [pa.array(code[edge].view(np.int64)), pa.array(ids[edge], mask=several)], names=["code", "id"]
                )

    owners = texts.select("doc_id", "text").mapInArrow(run, "code long, id long").groupBy("code").agg(
        F.min("id").alias("id"), F.max("id").alias("last"), F.count_if(F.col("id").isNull()).alias("shared")
    )
    return owners.filter("shared = 0 and id = last").groupBy("id").agg(F.count("*").alias("alone"))


def rarest(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members without the signatures that most others have, too, as many as still leave one
    shared with any similar set: with `asks` shared ones, the rarest of those has `asks` - 1
    behind it in the order of both sets."""
    counts = keep(members.groupBy("signature").agg(F.count("*").alias("n")), "crowds")
    every = members.join(counts, "signature").join(sizes.select(F.col("doc_id").alias("id"), "asks"), "id")
    own = Window.partitionBy("id")
    place = F.row_number().over(own.orderBy("n", "signature"))
    ranked = every.withColumns({"place": place, "met": F.count("*").over(own)})
    return ranked.filter("place <= met - asks + 1").select(*members.columns)


def meeting(members: DataFrame, sizes: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b), once or more, of members of different components that may be similar.

    Pairs that cannot be are no rows: in a large group members are told apart by their bits.
    """
    chosen, ends = rarest(members, sizes), []
    for end in ("a", "b"):
        side = chosen.select("signature", F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
        ends.append(keep(side.join(known(sizes, end), end), "open-ends"))
        chosen = ends[0].select("signature", F.col("a").alias("id"), F.col("of_a").alias("component"))
    met = ends[0].join(ends[1], "signature").filter((F.col("of_a") > F.col("of_b")) & close(share))
    return met.select("a", "b")


def across(
    members: DataFrame, labels: DataFrame, sizes: DataFrame, texts: DataFrame, words_each: int, share: int
) -> DataFrame:
    """Pairs that share signatures across components, as many as similar sets do: what
    joining to one member of each signature has left open.

    A member goes if too many of its features are in no other open member: whatever a
    similar set lacks is at most 100 - `share` percent of it.
    """
    placed = keep(labelled(members, "id", labels, "component"), "placed")
    for turn in range(3):
        several = placed.groupBy("signature").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        ).filter("low <> high")
        several = keep(several.select("signature"), "open")
        open_ = sifted(placed, several, ["signature"]).join(several, "signature", "left_semi")
        placed = keep(viable(keep(open_, "open-members"), sizes), "open-members")
        if turn < 2:
            ids = keep(placed.select(F.col("id").alias("doc_id")).distinct(), "open-ids")
            # a text more could share the features of others, so the join decides
            own = sifted(texts, ids, ["doc_id"]).join(ids, "doc_id", "left_semi")
            alone = unshared(own, words_each)
            alone = alone.join(sizes.select(F.col("doc_id").alias("id"), "most"), "id")
            gone = alone.filter(100 * (F.col("most") - F.col("alone")) < share * F.col("most"))
            placed = placed.join(keep(gone.select("id"), "lonely"), "id", "left_anti")
    return meeting(placed, sizes, share).distinct()


def link_components(documents: DataFrame, words_each: int, share: int) -> DataFrame:
    """Each row's doc_id, n_shingles and component_id, the smallest doc_id reachable by links.

    Null or word-less texts have no features and link with nothing, also not with each
    other. Rows of one doc_id are one vertex; a null doc_id links with nothing and has no
    component. Other columns are not read; an empty table gives no rows.
    """
    sized = keep(sets(documents, words_each, share), "sets")
    same = ["n_shingles", "first", "second"]
    some = sized.filter("n_shingles > 0 and doc_id is not null")
    leaders = some.groupBy(*same).agg(F.min("doc_id").alias("leader"), F.count("*").alias("n"))
    leaders = keep(leaders.filter("n > 1").drop("n"), "leaders")
    copies = some.join(leaders, same).select(F.col("doc_id").alias("a"), F.col("leader").alias("b"))
    member = components(copies)
    alone = (F.min("first") == F.max("first")) & (F.min("second") == F.max("second"))
    sizes = keep(some.groupBy("doc_id").agg(
        F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"), F.min("differ").alias("differ"),
        F.min("asks").alias("asks"),
        *(F.when(alone, F.min(c)).alias(c) for c in SKETCH),
    ), "sizes")

    met = keep(shared(signed(documents, words_each, share)), "signatures")
    members = met.select("signature", F.explode(F.array("id", "least")).alias("doc"))
    members = labelled(members, "doc", member, "id").select("signature", "id").distinct()
    members = keep(viable(keep(members, "members"), sizes), "members")
    first = members.groupBy("signature").agg(F.min("id").alias("b"), F.count("*").alias("n"))
    first = keep(first.filter("n > 1").drop("n"), "first-members")
    tried = members.join(first, "signature").filter("id <> b").groupBy(F.col("id").alias("a"), "b")
    tried = keep(alike(tried.agg(F.count("*").alias("support")), sizes, share), "candidates")
    wanted = keep(members.select(F.col("id").alias("doc_id")).distinct(), "wanted")
    # a text more is one that no pair asks for, so no text is shuffled to leave it out
    texts = documents.select("doc_id", "text").filter("text is not null and doc_id is not null")
    texts = keep(sifted(texts, wanted, ["doc_id"]), "texts")

    best = keep(tried.groupBy("a").agg(F.max_by("b", F.struct("support", "b")).alias("b")), "best")
    links = keep(compared(texts, best, words_each, share), "links")
    labels = components(links)
    rest = keep(apart(tried, labels).join(best, ["a", "b"], "left_anti"), "rest")
    links = keep(links.unionByName(compared(texts, rest, words_each, share)), "links")
    labels = components(links)
    crossing = across(members, labels, sizes, texts, words_each, share).join(tried, ["a", "b"], "left_anti")
    links = links.unionByName(compared(texts, keep(crossing, "crossing"), words_each, share))
    edges = links.unionByName(member.select(F.col("id").alias("a"), F.col("component").alias("b")))
    return labelled(sized, "doc_id", components(edges), "component_id").select(
        "doc_id", "n_shingles", "component_id"
    )
