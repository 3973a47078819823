"""Document fingerprints by invertible Bloom lookup sketches (operator 9),
DataFrame operations only.

A text is the set of digests of its paragraphs (lines; long ones are cut, see
``pieces``).  The sketch hashes every digest into one cell of each of three
tables; a cell holds a count, the XOR of its digests and the XOR of their check
sums.  Subtracting the cells of two versions cancels what they share.  Peeling
then recovers the rest: a cell with count 1 or -1 whose check sum fits holds a
single digest, which is taken out of its other cells, until all are empty.
The recovered digests of either side give the likeness |A and B| / |A or B|.
Pairs that keep cells are tried again with a larger sketch, sized by their two
counts and doubled on every further failure, until none is left.

Cells are rows, and every step is a projection and a hash aggregation by
(document, pair, cell).  The narrow table of digests is checkpointed and
partitioned by document; all grouping keys begin with the document, so cells
are never shuffled.  The other shuffles bring a document together with its
successor's opening.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.common import checkpointed, col, text_of
from lakesmith.operators.keys import number_rows

TABLES = 3
#: Cells of a table of the fingerprint itself, and the least of a retry.
WIDTH, RETRY_WIDTH = 8, 16
#: Passes over all tables while peeling.
ROUNDS = 4
#: Piece lengths in code points: the opening of a text, then the rest.
OPENING, SHORT, LONG = 128, 16, 192

_DOC = ["k1", "k2"]
_FOUND_PLUS, _FOUND_MINUS = -1, -2


def pieces(text: Column) -> Column:
    """Paragraphs (lines) of a text, cut from their start into pieces of
    ``LONG`` code points; the first ``OPENING`` code points into ``SHORT`` ones,
    so that a change inside a short text leaves some of it unchanged."""
    head = F.regexp_extract_all(F.substring(text, 1, OPENING), F.lit(f"[^\n]{{1,{SHORT}}}"), F.lit(0))
    rest = F.regexp_extract_all(F.substring(text, OPENING + 1, F.char_length(text)), F.lit(f"[^\n]{{1,{LONG}}}"), F.lit(0))
    return F.concat(head, rest)


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the pieces."""
    return F.array_distinct(F.transform(pieces(text), lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(F.lit(99), digest).bitwiseAND(F.lit(0xFFFFFFFF))


def _place(digest: Column, table: Column, width: Column) -> Column:
    """The digest's cell in a table; the widths are powers of two, and another
    width gives other neighbours."""
    h = F.xxhash64(width, table, digest)
    return h.bitwiseAND(width - 1) * TABLES + table


def _cells(entries: DataFrame, by: list[str]) -> DataFrame:
    """Cells of the entries (by..., w, sign, k): signed counts and XORs."""
    placed = F.array(*[_place(F.col("k"), F.lit(t), F.col("w")) for t in range(TABLES)])
    return (entries.select(*by, "w", "sign", "k", _check(F.col("k")).alias("c"), F.explode(placed).alias("cell"))
            .groupBy(*by, "w", "cell").agg(F.sum("sign").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c")))


def peel(cells: DataFrame) -> DataFrame:
    """(k1, k2, pair, w, cell, n, k, c) -> (k1, k2, pair, plus, minus, ok):
    digests recovered on either side; not ok if cells remain.  A pair without
    any cell has no row: its versions are equal."""
    live = (F.col("cell") < 0) | (F.col("n") != 0) | (F.col("k") != 0) | (F.col("c") != 0)
    state, by = cells.where(live), [*_DOC, "pair", "w", "cell"]

    for step in range(TABLES * ROUNDS):
        table = step % TABLES
        others = [t for t in range(TABLES) if t != table]
        # a digest has one cell in a table, so none is taken out twice
        pure = ((F.col("cell") >= 0) & (F.col("cell") % TABLES == table) & (F.abs("n") == 1)
                & (_check(F.col("k")) == F.col("c")))
        # a pure cell becomes a recovered digest (0) and what leaves its other cells (1, 2)
        parts = F.when(pure, F.array(*[F.lit(i) for i in range(TABLES)])).otherwise(F.array(F.lit(-1)))
        i, zero = F.col("i"), F.lit(0).cast("long")
        cell = F.when(i == -1, F.col("cell")).when(
            i == 0, F.when(F.col("n") > 0, F.lit(_FOUND_PLUS)).otherwise(F.lit(_FOUND_MINUS)).cast("long")).otherwise(
            _place(F.col("k"), F.when(i == 1, others[0]).otherwise(others[1]), F.col("w")))
        state = (state.select(*by, "n", "k", "c", F.explode(parts).alias("i"))
                 .select(*_DOC, "pair", "w", cell.alias("cell"),
                         F.when(i == -1, F.col("n")).when(i == 0, F.lit(1).cast("long")).otherwise(-F.col("n")).alias("n"),
                         F.when(i == 0, zero).otherwise(F.col("k")).alias("k"),
                         F.when(i == 0, zero).otherwise(F.col("c")).alias("c"))
                 .groupBy(*by).agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c")).where(live))

    def count(kind: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("cell") == kind, F.col("n"))), F.lit(0))

    return state.groupBy(*_DOC, "pair").agg(count(_FOUND_PLUS).alias("plus"), count(_FOUND_MINUS).alias("minus"),
                                            (F.max("cell") < 0).alias("ok"))


def _labelled(values: Column, pair: Column, sign: int) -> Column:
    return F.transform(values, lambda d: F.struct(pair.alias("pair"), F.lit(sign).cast("long").alias("sign"), d.alias("k")))


def _entries(rows: DataFrame, lists: list[Column], width: Column) -> DataFrame:
    """(k1, k2, pair, w, sign, k): labelled digest lists as rows."""
    return rows.select(*_DOC, width.alias("w"), F.explode(F.concat(*lists)).alias("x")).select(*_DOC, "w", "x.*")


def sketches(rows: DataFrame, versions: list[str]) -> DataFrame:
    """Cells (k1, k2, pair: version, w, cell, n, k, c) of every version's digests."""
    lists = [_labelled(F.col(v), F.lit(v), 1) for v in versions]
    return _cells(_entries(rows, lists, F.lit(WIDTH).cast("long")), [*_DOC, "pair"])


def sketch_texts(cells: DataFrame, names: dict[str, str]) -> DataFrame:
    """(k1, k2, name...): sketches as base64 text, 16 bytes for each cell that
    is not empty: number, count modulo 2^24, digests, check sums."""
    digits = F.concat(F.lpad(F.hex("cell"), 2, "0"), F.lpad(F.hex(F.col("n").bitwiseAND(F.lit(0xFFFFFF))), 6, "0"),
                      F.lpad(F.hex("k"), 16, "0"), F.lpad(F.hex("c"), 8, "0"))
    rows = cells.where(F.col("pair").isin(*names)).select(*_DOC, "pair", digits.alias("d"))
    lists = rows.groupBy(*_DOC).agg(*[F.array_join(F.sort_array(F.collect_list(F.when(F.col("pair") == v, F.col("d")))), "")
                                      .alias(name) for v, name in names.items()])
    return lists.select(*_DOC, *[F.regexp_replace(F.base64(F.unhex(name)), "\\s", "").alias(name) for name in names.values()])


def differences(rows: DataFrame, base: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """(k1, k2, pair, plus, minus): how many digests the first and the second
    side of every named pair of digest columns hold alone, recovered from the
    sketches ``base`` and from larger ones where those fail.  Pairs of equal
    sets have no row."""
    uses = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(p).alias("p"), F.lit(sign).cast("long").alias("s"))
                     for p, (a, b) in pairs.items() for v, sign in ((a, 1), (b, -1))])
    signed = base.withColumn("x", F.explode(uses)).where("pair = x.v")
    minus = signed.groupBy(*_DOC, F.col("x.p").alias("pair"), "w", "cell").agg(
        F.sum(F.col("n") * F.col("x.s")).alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"))
    tried = checkpointed(peel(minus))
    found = tried.where("ok")
    both = rows.join(tried.where("not ok").select(*_DOC, "pair"), _DOC)
    a, b = (F.coalesce(*[F.when(F.col("pair") == p, F.col(sides[i])) for p, sides in pairs.items()]) for i in (0, 1))
    left, growth = both.select(*_DOC, "pair", a.alias("a"), b.alias("b")), 1
    while True:
        # a table for half the digests that can differ, rounded up to a power of two
        need = F.greatest((F.size("a") + F.size("b")) / 2.0, F.lit(float(RETRY_WIDTH)))
        width = (F.pow(F.lit(2.0), F.ceil(F.log2(need))) * growth).cast("long")
        lists = [_labelled(F.col("a"), F.col("pair"), 1), _labelled(F.col("b"), F.col("pair"), -1)]
        peeled = peel(_cells(_entries(left, lists, width), [*_DOC, "pair"]))
        # only pairs that failed again keep their digests
        again = [F.when(~F.col("ok"), F.col(x)).alias(x) for x in "ab"]
        # joined by document alone, as both sides are partitioned; a document has few pairs
        same = (F.col("pair") <= F.col("p")) & (F.col("pair") >= F.col("p"))
        tried = checkpointed(peeled.join(left.withColumnRenamed("pair", "p"), _DOC).where(same)
                             .select(*_DOC, "pair", "plus", "minus", "ok", *again))
        found, growth = found.unionByName(tried.where("ok").drop("a", "b")), growth * 2
        left = tried.where("not ok").select(*_DOC, "pair", "a", "b").repartition(*_DOC)
        if left.isEmpty():
            return found.select(*_DOC, "pair", "plus", "minus")


def document_keys(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Identity of a document as two digests that are never null: of its id and of its text."""
    return [F.xxhash64(F.coalesce(col(id_col).cast("string"), F.lit("~"))).alias("k1"),
            F.xxhash64(text_of(text_col)).alias("k2")]


def successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, b1, b2, taken): each distinct document, the one (b1, b2) whose
    successor it is in id order (ties by digest, nulls last, the first follows
    the last), and how many of its opening code points that one takes: a quarter
    of its own length."""
    narrow = docs.select(col(id_col).alias("id"), *document_keys(id_col, text_col),
                         F.char_length(text_of(text_col)).alias("n")).distinct()
    numbered = number_rows(narrow, "no", ["id", "k2", "k1"], keep=["k1", "k2", "n"])
    last = numbered.agg(F.max("no")).scalar()
    follows = numbered.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"),
                              F.floor(F.col("n") / 4).cast("int").alias("taken"), (F.col("no") % last + 1).alias("no"))
    return numbered.select("k1", "k2", "no").join(follows, "no").drop("no")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text has its last quarter (rounded down) replaced by as many
    opening code points of the next document.  Null texts count as empty; an
    empty text has an empty fingerprint, and two of them have likeness 1.  Rows
    that repeat id and text are one document and each get its result; a lone
    document is its own successor; an empty table gives an empty result.
    """
    rows = docs.select(col(id_col).alias("id"), *document_keys(id_col, text_col), text_of(text_col).alias("text"))
    one = rows.groupBy(*_DOC).agg(F.first("id").alias("id"), F.first("text").alias("text"),
                                  F.count(F.lit(1)).cast("int").alias("copies"))
    # naming every column keeps both uses of the grouped texts one plan, so they are shuffled once
    linked = one.where("copies > 0 or id is not null").join(successors(docs, id_col, text_col), _DOC)
    sent = linked.select(F.col("b1").alias("k1"), F.col("b2").alias("k2"), digests(F.col("text")).alias("c"),
                         F.substring(F.col("text"), F.lit(1), F.col("taken")).alias("opening"))
    met = one.join(sent, _DOC)
    n = F.char_length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / 4).cast("int")), "opening")
    met = met.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    met = checkpointed(met.select(
        *_DOC, "id", "copies", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("b"), "c"))
    # narrow; all cells of a document stay in its partition from here on
    lists = met.select(*_DOC, "a", "b", "c").repartition(*_DOC)
    facts = met.select(*_DOC, "id", "copies", "n_chars", "edited_sha256", F.size("a").alias("size"))
    cells = sketches(lists, ["a", "b", "c"])
    texts = sketch_texts(cells, {"a": "fingerprint", "b": "edited_fingerprint"})
    sides = {"near_edited": ("a", "b"), "near_next": ("a", "c")}
    counts = differences(lists, cells, sides).groupBy(*_DOC).agg(*[
        F.max(F.when(F.col("pair") == p, F.struct("plus", "minus"))).alias(p) for p in sides])
    out = facts.join(texts, _DOC, "left").join(counts, _DOC, "left")

    def ratio(name: str) -> Column:
        plus, minus = (F.coalesce(F.col(name)[x], F.lit(0)) for x in ("plus", "minus"))
        union = F.col("size") + minus
        return F.when(union == 0, 1.0).otherwise((F.col("size") - plus) / union).cast("double").alias(name)

    return out.select("id", "n_chars", "edited_sha256",
                      *[F.coalesce(x, F.lit("")).alias(x) for x in ("fingerprint", "edited_fingerprint")],
                      *[ratio(p) for p in sides], F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, fingerprint) of every distinct document; equal texts have equal
    fingerprints, a text without content has no row."""
    rows = docs.select(*document_keys(id_col, text_col), digests(text_of(text_col)).alias("a")).dropDuplicates(_DOC)
    return sketch_texts(sketches(rows, ["a"]), {"a": "fingerprint"})
