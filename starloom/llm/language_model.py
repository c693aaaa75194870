"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text, cut by quantiles per language.

The model is over 5-grams of characters: each is one of 512 classes (Latin lower-case letters by
themselves, the accented ones too, capitals, digits, white space, marks by kind, and the letters of
all other scripts by code point modulo 448, so that letters of one alphabet keep apart), and a 5-gram
is a number below 2^45. Words would be the usual units, but their trigrams are almost all different,
and moving their counts costs several times the input; character 5-grams are counted within each
task before anything moves.

1. Every task counts the 5-grams of all its documents by language and fold (a hash of the text),
   and how often they are in trusted ones (labelled good and not toxic). The counts are added
   up, sharded by 5-gram, those of all folds in one row. A fold's model is of the trusted text of
   all other folds, so no document is scored by a model that has seen it or an exact copy of it.
2. Joins on 5-gram, context and shortened 5-gram, order by order, give every 5-gram of the
   corpus its interpolated log probability; discounts are from counts of counts per language.
   What an order leaves for the next is kept as files until the documents are scored.
3. A document has a perplexity over all its characters and one of its worst passage, the
   ``PASSAGE`` consecutive characters that are least likely: a few inserted words hardly show
   in the former. If there are at most ``TABLE`` rows in the table of step 2 (counted),
   tasks look 5-grams up in a copy; beyond that, the
   documents' 5-grams are joined with the table and come back to their text.
4. The cuts of a language are quantiles of its trusted documents' perplexities, all held out;
   a document is rejected if its own or its worst passage's is higher.

Short texts say little, so a perplexity is shrunk: ``PRIOR`` characters at the model's own mean
are added to every document's. A passage of a text shorter than ``PASSAGE`` is taken to go on
with certain characters.

Defined results: null and empty texts have no perplexity and are kept; so are documents of a
language without trusted documents (null counts as a language); if all trusted text of a language
is in one fold, its model is of all of it; repeated rows are judged each
and count each; several labels of a document must all trust it; a null or unlabelled doc_id is
not trusted; an empty table gives no rows; columns of any name are carried along.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from starloom.llm.common import SLICE, fields, mapped, sliced, small, sums_by
from starloom.session import cut
from starloom.sinks.files import shelf

ORDER = 5
BITS = 9
CLASSES = 1 << BITS
#: Classes of Latin letters, digits, white space and marks; the others are of letters of other scripts.
LATIN = 64
#: Bytes of text that are worked on together; a character takes 8 bytes in each array.
TOGETHER = SLICE // 2
#: Names of models (by language and fold) that a task counts for together.
NAMES = 200_000
#: Rows (16 bytes each) up to which every task gets a copy of the model.
TABLE = 4_000_000
QUANTILE = 0.998
#: Of the worst passages: more trusted documents have a key or another language in one than are odd as a whole.
PASSAGE_QUANTILE = 0.99
PASSAGE = 16
FOLDS = 4
PRIOR = 50

_ACCENTED = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"


def _classes() -> np.ndarray:
    """Class by code point below 0x180: 0 is the start of a text, 1 any other sign."""
    out = np.full(0x180, 1, np.uint16)
    for group, chars in enumerate(["\t\n\v\f\r", " ", "0123456789", ".", ",", "!?", ";:", "\"'()[]-", "|", "#*$%&<>=+/\\^_`{}~@"]):
        for c in chars:
            out[ord(c)] = 2 + group
    for k in range(26):
        out[97 + k], out[65 + k] = 20 + k, 12
    # More accented letters than classes: the rarest share.
    for k, c in enumerate(_ACCENTED):
        out[ord(c)] = 46 + k % 18
        if ord(c.upper()[0]) < 0x180 and c != "ß":
            out[ord(c.upper()[0])] = 12
    return out


CLASS = _classes()


def _read(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The classes of the characters of ``size`` bytes that begin at ``at``."""
    points = data[at].astype(np.int64) & (0x7F >> size)
    for k in range(1, size):
        points = points << 6 | data[np.minimum(at + k, len(data) - 1)] & 0x3F
    sign = (points >= 0x2000) & (points < 0x2C00) | (points >= 0x1F000) & (points < 0x20000)
    other = np.where(sign, 1, LATIN + points % (CLASSES - LATIN))
    return np.where(points < 0x180, CLASS[np.minimum(points, 0x17F)], other)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 5-gram that ends at every character, and the number of characters before each text."""
    # Every lead byte is a character.
    classes = CLASS[data]
    for size, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0x100)):
        at = np.flatnonzero((data >= low) & (data < high))
        if len(at):
            classes[at] = _read(data, at, size)
    lead = (data & 0xC0) != 0x80
    first = np.concatenate(([0], np.cumsum(sums_by(lead, offsets))))
    classes = classes[lead].astype(np.uint64)
    out = classes.copy()
    for back in range(1, ORDER):
        out[back:] |= classes[:-back] << np.uint64(BITS * back)
    for k in range(ORDER - 1):
        # The k-th character of a text has k before it.
        at = first[:-1] + k
        out[at[at < first[1:]]] &= np.uint64((1 << BITS * (k + 1)) - 1)
    return out, first


class _Counts:
    """Sorted keys and how often each was seen, merged now and then so that memory follows the different keys."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.waiting += len(self.parts[-1][0])
        if self.waiting > 2_000_000:
            self.parts = [self.merged()]
            self.waiting = len(self.parts[0][0]) // 2

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.waiting:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.add.reduceat(counts, first)


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, c) for all 5-grams of ``docs`` (lang, trusted, text), by task; c counts those in trusted documents."""
    schema = StructType([*fields(strings="lang"), *fields("gram c")])
    width = np.uint64(BITS * ORDER + 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        counts = _Counts()
        for part, data, offsets in sliced(batches, limit=TOGETHER):
            if len(langs) > NAMES:
                yield from told(langs, counts)
                langs, counts = {}, _Counts()
            codes, first = grams(data, offsets)
            own = np.array([langs.setdefault(x, len(langs)) for x in part.column("lang").to_pylist()], np.uint64)
            trust = np.array(part.column("trusted").to_pylist(), np.uint64)
            high = (own << width) | trust
            counts.add((codes << np.uint64(1)) | np.repeat(high, np.diff(first)))
        yield from told(langs, counts)

    def told(langs: dict[str, int], counts: _Counts) -> Iterator[pa.RecordBatch]:
        keys, n = counts.merged()
        n = np.where(keys & np.uint64(1), n, 0)
        names = np.array([*langs, ""], object)
        for at in range(0, len(keys), 50_000):
            k = keys[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[(k >> width).astype(np.int64)], pa.string()),
                    pa.array(((k >> np.uint64(1)) & np.uint64((1 << BITS * ORDER) - 1)).astype(np.int64)),
                    pa.array(n[at : at + 50_000].astype(np.int64)),
                ],
                ["lang", "gram", "c"],
            )

    return mapped(docs.select("lang", "trusted", "text"), work, schema)


def fold_key(lang: Column, text: Column) -> Column:
    """The name of the model that scores a text: its fold, a digit, and its language."""
    return F.concat(F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("string"), lang)


def held_out(counts: DataFrame, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """``counts`` by fold and language, in any number of rows, to the same names, with what all the other folds' trusted documents have."""
    own = counts.select(F.substr("lang", F.lit(2)).alias("name"), F.substring("lang", 1, 1).cast("int").alias("fold"), "gram", "c")
    folds = [F.sum(F.when(F.col("fold") == k, F.col("c"))).alias(f"own{k}") for k in range(FOLDS)]
    # Tasks put the folds of a gram into one row before anything moves.
    wide = keep(own.groupBy("name", "gram").agg(*folds))
    sums = [F.coalesce(F.sum(f"own{k}"), F.lit(0)) for k in range(FOLDS)]
    alone = cut(wide.groupBy("name").agg((F.greatest(*sums) == sum(sums)).alias("alone")))
    total = sum(F.coalesce(f"own{k}", F.lit(0)) for k in range(FOLDS))
    # A fold has a gram if its own documents or the others' trusted ones do.
    each = [
        F.struct(
            F.concat(F.lit(str(k)), "name").alias("lang"), "gram",
            (total - F.when(F.col("alone"), F.lit(0)).otherwise(F.coalesce(f"own{k}", F.lit(0)))).alias("c"),
            F.col(f"own{k}").isNotNull().alias("seen"),
        )
        for k in range(FOLDS)
    ]
    return wide.join(small(alone), "name").select(F.inline(F.array(*each))).where("seen or c > 0").select("lang", "gram", "c")


def model(counts: DataFrame, order: int = 4, bits: int = 6, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """(lang, gram, logp) for every gram of ``counts``, of ``order`` classes of ``bits`` each; languages without trusted text have none."""
    level = {order: counts.select("lang", "gram", "c")}
    for k in range(order - 1, 0, -1):
        # Below the highest order a gram counts the different grams that end in it; 0 if only untrusted text has them.
        tail = F.col("gram").bitwiseAND(F.lit((1 << bits * k) - 1)).alias("gram")
        level[k] = keep(level[k + 1].groupBy("lang", tail).agg(F.count_if(F.col("c") > 0).alias("c")))
    of = [F.count_if(F.col("c") == n).cast("double").alias(f"n{n}") for n in (1, 2, 3, 4)]
    every = reduce(DataFrame.unionByName, (rows.withColumn("k", F.lit(k)) for k, rows in level.items()))
    steps = every.where("c > 0").groupBy("k", "lang").agg(*of)
    # Without counts to estimate it from, or with such that leave nothing or more than all, a discount is the
    # usual half, one or one and a half: every context keeps some mass, so every probability is positive.
    y = "n1 / (n1 + 2 * n2)"
    for n, usual in ((1, 0.5), (2, 1.0), (3, 1.5)):
        steps = steps.withColumn(
            f"d{n}",
            F.expr(f"if(n{n} > 0 and n{n + 1} > 0, {n} - {n + 1} * {y} * n{n + 1} / n{n}, {usual}D)"),
        ).withColumn(f"d{n}", F.expr(f"if(d{n} > 0 and d{n} <= {n}, d{n}, {usual}D)"))
    # Unless it is broadcast, all grams move once more for it.
    steps = small(cut(steps.select("k", "lang", "d1", "d2", "d3")))
    lower = None
    for k in range(1, order + 1):
        # All grams of a context, of which there are at most as many as classes, meet once.
        near = Window.partitionBy("lang", F.shiftright("gram", bits))
        rows = level[k].select(
            "lang", "gram", "c",
            F.sum(F.when(F.col("c") > 0, F.col("c"))).over(near).alias("total"),
            F.count_if(F.col("c") == 1).over(near).alias("m1"),
            F.count_if(F.col("c") == 2).over(near).alias("m2"),
            F.count_if(F.col("c") > 2).over(near).alias("m3"),
        )
        if lower is None:
            rows = rows.withColumn("below", F.lit(1.0 / (1 << bits)))
        else:
            below = keep(lower).select(F.col("lang").alias("of"), F.col("gram").alias("tail"), F.col("p").alias("below"))
            shorter = F.col("gram").bitwiseAND(F.lit((1 << bits * (k - 1)) - 1))
            rows = rows.join(below, (F.col("lang") == F.col("of")) & (shorter == F.col("tail")))
        p = F.expr(
            "if(total is null, below, greatest(0D, c - case when c = 0 then 0"
            " when c = 1 then d1 when c = 2 then d2 else d3 end) / total + (d1 * m1 + d2 * m2 + d3 * m3) / total * below)"
        )
        lower = rows.join(steps.where(F.col("k") == k).drop("k"), "lang").select("lang", "gram", p.alias("p"))
    return lower.select("lang", "gram", F.log("p").alias("logp"))


class Lookup:
    """The log probabilities of one language's grams, in their order."""

    def __init__(self, gram: np.ndarray, logp: np.ndarray) -> None:
        if (gram[1:] < gram[:-1]).any():
            order = np.argsort(gram)
            gram, logp = gram[order], logp[order]
        self.gram, self.logp = gram, logp

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.gram, codes), len(self.gram) - 1)
        # A gram that the corpus hasn't: as likely as any character.
        return np.where(self.gram[place] == codes, self.logp[place], np.float32(-np.log(CLASSES)))


def _arrays(table: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    names = sorted(r["lang"] for r in table.select("lang").distinct().collect())  # a row per language and fold
    if not names:
        return {}
    # Sixteen bytes a row reach the driver, no strings.
    number = F.array_position(F.array(*map(F.lit, names)), F.col("lang")).cast("int").alias("number")
    rows = table.select(number, "gram", "logp").toArrow()
    number, gram, logp = (rows.column(c).to_numpy() for c in ("number", "gram", "logp"))
    order = np.lexsort((gram, number))
    ends = np.searchsorted(number[order], np.arange(1, len(names) + 2))
    return {
        k: (gram[order[a:b]].astype(np.uint64), logp[order[a:b]])
        for k, a, b in zip(names, ends.tolist(), ends[1:].tolist())
    }


def _by_text(losses: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and worst passage of every text's losses; ``n`` characters belong to each. No value reaches another text."""
    loss, worst = np.zeros(len(n)), np.zeros(len(n))
    if len(losses):
        begin = np.cumsum(n) - n
        at = begin[n > 0]
        loss[n > 0] = np.add.reduceat(losses, at)
        place = np.arange(len(losses)) - np.repeat(begin, n)
        size = 1
        while size < PASSAGE:
            more = losses.copy()
            more[size:] += np.where(place[size:] >= size, losses[:-size], 0.0)
            losses, size = more, 2 * size
        worst[n > 0] = np.maximum.reduceat(losses, at)
    return loss, worst


def _losses(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, lookups: dict[str, Lookup]):
    """Per text its negative log likelihood and its worst passage's (NaN without a model), and its characters."""
    codes, first = grams(data, offsets)
    langs = part.column("lang").to_pylist()
    out, worst = np.full(len(langs), np.nan), np.full(len(langs), np.nan)
    for lang in dict.fromkeys(langs):
        if lang in lookups:
            mine = np.array([x == lang for x in langs])
            marks = np.repeat(mine, np.diff(first))
            out[mine], worst[mine] = _by_text(-lookups[lang](codes[marks]).astype(np.float64), np.diff(first)[mine])
    return out, worst, np.diff(first)


def _losses_by_join(docs: DataFrame, table: DataFrame) -> DataFrame:
    """``docs`` (key, lang, text) to (key, loss, worst, n): their 5-grams joined with the table, then back to the text."""
    schema = StructType([*fields(strings="key lang"), *fields("gram")])

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in sliced(batches, limit=1 << 20):
            codes, first = grams(data, offsets)
            row = np.repeat(np.arange(part.num_rows, dtype=np.uint64), np.diff(first))
            keys = np.unique((row << np.uint64(BITS * ORDER)) | codes)
            row = pa.array((keys >> np.uint64(BITS * ORDER)).astype(np.int64))
            gram = pa.array((keys & np.uint64((1 << BITS * ORDER) - 1)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([part.column("key").take(row), part.column("lang").take(row), gram], ["key", "lang", "gram"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in sliced(batches, limit=TOGETHER):
            codes, first = grams(data, offsets)
            have, logs = part.column("grams"), np.zeros(len(codes))
            for k in range(part.num_rows):
                mine, known = slice(first[k], first[k + 1]), have[k].values
                gram, logp = known.field("gram").to_numpy().astype(np.uint64), known.field("logp").to_numpy()
                order = np.argsort(gram)
                gram, logp = gram[order], logp[order]
                at = np.minimum(np.searchsorted(gram, codes[mine]), len(gram) - 1)
                logs[mine] = np.where(gram[at] == codes[mine], logp[at], -np.log(CLASSES))
            loss, worst = _by_text(-logs, np.diff(first))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(loss), pa.array(worst), pa.array(np.diff(first).astype(np.int64))], out.fieldNames()
            )

    out = StructType([*fields(strings="key"), *fields(loss=DoubleType(), worst=DoubleType()), *fields("n")])
    row = F.struct("gram", "logp")
    known = mapped(docs.select("key", "lang", "text"), different, schema).join(table, ["lang", "gram"])
    known = known.groupBy("key").agg(F.collect_list(row).alias("grams"))
    return mapped(docs.select("key", "text").join(known, "key").select("key", "text", "grams"), work, out)


def lang_key() -> Column:
    return F.coalesce(F.col("lang"), F.lit("\u0001"))


def _row_key() -> Column:
    return F.sha2(F.concat_ws("\u0001", F.col("doc_id").cast("string"), lang_key(), "text"), 256)


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, table_rows: int = TABLE) -> DataFrame:
    """Per row: doc_id, lang, n_chars, perplexity, cut, kept, and the worst passage's perplexity and cut."""
    scored, _, stats = _scored(docs, labels, quantile, table_rows)
    return (
        scored.join(small(stats), "key_lang", "left")
        .withColumns({"perplexity": _perplexity(), "passage": _passage()})
        .select(
            "doc_id", "lang", F.col("n").alias("n_chars"), "perplexity", "cut", (~F.coalesce(_over(), F.lit(False))).alias("kept"),
            "passage", "passage_cut",
        )
    )


def _perplexity() -> Column:
    return F.when(F.col("n") > 0, F.exp((F.col("loss") + PRIOR * F.col("mean")) / (F.col("n") + PRIOR)))


def _passage() -> Column:
    return F.when(F.col("n") > 0, F.exp(F.col("worst") / PASSAGE))


def _over() -> Column:
    return (_perplexity() > F.col("cut")) | (_passage() > F.col("passage_cut"))


def _scored(docs: DataFrame, labels: DataFrame, quantile: float, table_rows: int):
    """Losses of all rows, the model table if it may be copied, and mean and cuts by language."""
    good = (
        labels.groupBy("doc_id")
        .agg((F.min(F.coalesce("quality", F.lit(0))) == 1).alias("good"), (F.max(F.coalesce("toxic", F.lit(1))) == 0).alias("mild"))
        .where("good and mild")
        .select("doc_id", F.lit(True).alias("trusted"))
    )
    good = small(good)
    named = fold_key(lang_key(), F.col("text")).alias("model")
    flagged = docs.select("doc_id", named, "text").withColumnRenamed("model", "lang").join(good, "doc_id", "left")
    counts = corpus_counts(flagged.withColumn("trusted", F.coalesce("trusted", F.lit(False))))
    lookups = None
    with shelf(docs.sparkSession) as keep:
        table = keep(model(held_out(counts, keep), ORDER, BITS, keep).withColumn("logp", F.col("logp").cast("float")))
        if table.limit(table_rows + 1).count() <= table_rows:
            lookups = docs.sparkSession.sparkContext.broadcast(_arrays(table))
            scored = _with_losses(docs.select("doc_id", "lang", lang_key().alias("key_lang"), named, "text"), lookups)
        else:
            keyed = docs.select("doc_id", "lang", lang_key().alias("key_lang"), named, "text", _row_key().alias("key"))
            losses = _losses_by_join(keyed.select("key", F.col("model").alias("lang"), "text").dropDuplicates(["key"]), table)
            scored = keyed.drop("text").join(losses, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
            scored = scored.select("doc_id", "lang", "key_lang", "key", "loss", "worst", "n")
        scored = cut(scored)
    trusted = scored.join(good, "doc_id").where("loss is not null and n > 0")
    means = trusted.groupBy("key_lang").agg((F.sum("loss") / F.sum("n")).alias("mean"))
    cuts = (
        trusted.join(small(means), "key_lang")
        .groupBy("key_lang")
        .agg(
            F.percentile_approx(_perplexity(), quantile, 10_000).alias("cut"),
            F.percentile_approx(_passage(), PASSAGE_QUANTILE, 10_000).alias("passage_cut"),
        )
    )
    return scored, lookups, cut(means.join(cuts, "key_lang"))


def _with_losses(docs: DataFrame, lookups) -> DataFrame:
    """``docs`` (doc_id, lang, key_lang, model, text) with loss, worst and n in place of model and text."""
    names = [c for c in docs.columns if c not in ("model", "text")]
    schema = StructType([*(docs.schema[c] for c in names), *fields(loss=DoubleType(), worst=DoubleType()), *fields("n")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = {k: Lookup(*v) for k, v in lookups.value.items()}
        for part, data, offsets in sliced(batches, limit=TOGETHER):
            view = pa.RecordBatch.from_arrays([part.column("model")], ["lang"])
            loss, worst, n = _losses(view, data, offsets, opened)
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in names),
                    pa.array(loss, from_pandas=True), pa.array(worst, from_pandas=True), pa.array(n.astype(np.int64)),
                ],
                schema.fieldNames(),
            )

    return mapped(docs, work, schema)


def accepted(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, table_rows: int = TABLE) -> DataFrame:
    """The rows that the model keeps, with their own columns."""
    scored, lookups, stats = _scored(docs, labels, quantile, table_rows)
    row = F.struct(*docs.columns).alias("row")
    if lookups is None:
        bad = scored.join(small(stats), "key_lang", "left").where(_over()).select("key").distinct()
        return docs.select(row, _row_key().alias("key")).join(small(bad), "key", "left_anti").select("row.*")
    limits = {r["key_lang"]: (r["mean"], r["cut"], r["passage_cut"]) for r in stats.collect()}  # a row per language
    packed = docs.select(row, lang_key().alias("key_lang"), fold_key(lang_key(), F.col("text")).alias("lang"), "text")
    schema = StructType([packed.schema["row"]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = {k: Lookup(*v) for k, v in lookups.value.items()}
        for part, data, offsets in sliced(batches, limit=TOGETHER):
            loss, worst, n = _losses(part, data, offsets, opened)
            at = [limits.get(x, (0.0, np.inf, np.inf)) for x in part.column("key_lang").to_pylist()]
            mean, most, passage = np.array(at).reshape(-1, 3).T
            with np.errstate(over="ignore"):
                bad = (n > 0) & ((np.exp((loss + PRIOR * mean) / (n + PRIOR)) > most) | (np.exp(worst / PASSAGE) > passage))
            yield pa.RecordBatch.from_arrays([part.column("row")], ["row"]).filter(pa.array(~bad))

    return mapped(packed, work, schema).select("row.*")
