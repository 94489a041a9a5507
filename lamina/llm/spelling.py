"""Spelling variant grouping by pivotal grams, for words that differ by one code point.

A word's bigrams, ordered by how many words have them (rarest first), begin with its prefix: the three rarest and
all that are as rare as the third. Of the prefix two bigrams that do not overlap are its pivots, chosen by dynamic
programming for the least sum of frequencies. One edit destroys at most one of two bigrams that do not overlap; so
of two words within one edit, a pivot of the one whose prefix ends earlier in the order is in the other's prefix.
Every word's pivots therefore meet all words' prefixes, and no pair is lost.

Where a surviving bigram stands is limited: the edit is either behind it, and then everything up to its end is the
same in both words, or before it, and then everything from its start is, moved by the difference in length. The part
in which the edit is has two halves, of which one is the same in both words. Pivots look up (length, position, what
is the same), so that words which merely share a bigram do not meet. Pairs that meet are verified by their
edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import checkpointed

LEAST_LENGTH, LEAST_COUNT = 6, 5
# A form is at least so many times as frequent.
FORM_RATIO = 5
DAMAGE = 199
RUN = re.compile("[A-Za-zÀ-ÿ]+")
# Distinct words that a task counts before it passes the counts on.
WORDS_AT_ONCE = 200_000


def read_word(doc_id: str, run: str) -> str:
    """The lower-cased run, without one of its code points in every 199th case by the checksum."""
    lowered = run.encode().lower()
    check = zlib.crc32(lowered, zlib.crc32(f"{doc_id}:".encode()))
    word = lowered.decode()
    if check % DAMAGE == 0:
        at = check % len(word)
        word = word[:at] + word[at + 1 :]
    return word


def words_of(doc_id: str, text: str, least_length: int = LEAST_LENGTH) -> Counter:
    """Words of a text with their counts. Runs too short to give a word are passed over."""
    found: Counter = Counter()
    for run, n in Counter(RUN.findall(text)).items():
        if len(run) >= least_length and len(word := read_word(doc_id, run)) >= least_length:
            found[word] += n
    return found


def count_words(docs: DataFrame, doc_id: str, text: str, least_length: int, least_count: int) -> DataFrame:
    """(word, n) of the words that are frequent enough; tasks add up before the shuffle."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("d"), F.col(f"`{text}`").cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def counted():
            out = pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})
            counts.clear()
            return out

        for batch in batches:
            for i in range(batch.num_rows):
                counts.update(words_of(batch.column(0)[i].as_py() or "", batch.column(1)[i].as_py() or "", least_length))
                if len(counts) >= WORDS_AT_ONCE:
                    yield counted()
        yield counted()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def pivots_of(grams: list[tuple[int, int]]) -> tuple[int, int]:
    """Positions of the two bigrams, of (position, frequency) by position, that do not overlap and are rarest in sum.

    best[i]: the rarest single bigram among the first i, the state from which a second one is added.
    """
    best: list[tuple[int, int] | None] = [None]
    chosen = None
    for position, frequency in grams:
        free = sum(1 for p, _ in grams if p <= position - 2)
        if best[free] is not None:
            whole = (best[free][0] + frequency, best[free][1], position)
            chosen = min(chosen or whole, whole)
        single = (frequency, position)
        best.append(min(best[-1] or single, single))
    return chosen[1:]


def parts_of(word: str, p: int, length: int, at: int) -> list[str]:
    """What a word has in common with another one, of `length`, in which its bigram at `p` stands at `at`.

    One text for each place where the edit can be: in the first or second half of what is behind the bigram
    (only if that stands where it did), or of what is before it. Halves are those of the other word.
    """
    places = []
    if at == p:
        rest = length - at - 2
        half = rest // 2
        places += [f"<{word[: p + 2 + half]}", f"<{word[: p + 2]}>{word[len(word) - (rest - half) :]}"]
    if len(word) - p == length - at:
        half = at // 2
        places += [f"{word[:half]}<{word[p:]}>", f"{word[max(p - (at - half), 0) :]}>"]
    return [f"{length},{at},{i},{part}" for i, part in enumerate(places if at == p else ["", "", *places]) if part]


def keys_of(word: str, frequencies: list[int]) -> tuple[set[int], set[int]]:
    """What a word's pivots look up, and what its prefix is found by, as hashes."""
    ranks = sorted((f, word[p : p + 2]) for p, f in enumerate(frequencies))
    prefix = [(p, f) for p, f in enumerate(frequencies) if (f, word[p : p + 2]) <= ranks[2]]
    n = len(word)
    found_by = {k for p, _ in prefix for k in parts_of(word, p, n, p)}
    look_up = {k for p in pivots_of(prefix) for longer in (-1, 0, 1) for at in {p, p + longer} if at >= 0 for k in parts_of(word, p, n + longer, at)}
    return {hashed(k) for k in look_up}, {hashed(k) for k in found_by}


def hashed(key: str) -> int:
    value = xxhash.xxh64_intdigest(key)
    return value - (1 << 64) if value >> 63 else value


def near_pairs(words: DataFrame) -> DataFrame:
    """Words (word, n) -> (word, other) in both directions, for all pairs at edit distance 1."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))
    rows = words.select("word", F.posexplode(grams).alias("p", "gram"))
    held = rows.groupBy("gram").agg(F.count_distinct("word").alias("f"))
    # Bigrams: as many as pairs of letters, some 13,000 at most.
    known = rows.join(held, "gram").groupBy("word").agg(F.sort_array(F.collect_list(F.struct("p", "f"))).alias("g"))
    known = known.select("word", F.col("g.f").alias("f"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for word, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for pivot, keys in zip((True, False), keys_of(word, f)):
                    out += [(word, pivot, key) for key in keys]
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.int64())], names=["word", "pivot", "key"]
            )

    keys = checkpointed(known.mapInArrow(run, "word string, pivot boolean, key long"))
    asking = keys.where("pivot").select("word", "key")
    indexed = keys.where("NOT pivot").select(F.col("word").alias("other"), "key")
    met = asking.join(indexed, "key").where("word <> other AND levenshtein(word, other, 1) = 1")
    pairs = checkpointed(met.select(F.least("word", "other").alias("word"), F.greatest("word", "other").alias("other")).distinct())
    return pairs.union(pairs.select("other", "word"))


def follow(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): the end of each chain of forms, by joining chains to chains, twice as long each time."""
    now = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = checkpointed(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")




def group_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO
) -> DataFrame:
    """The words of all texts: word, n, n_near, form, form_n, root.

    Words are runs of letters (A-Z lower-cased, some damaged on purpose by `read_word`) of `least_length` code
    points, 4 at least, and `least_count` occurrences. n_near counts the words at edit distance 1; form is the most
    frequent of them (ties: smallest in code-point order) if it is at least `ratio` times as frequent as the word;
    root is the end of the chain of forms, the word itself if it has none. `ratio` is 2 at least, so that no chain
    is a circle. A null text has no words, a null id is an empty one for the checksum, every row counts, and a
    text may be of any length. No rows, or no frequent words, give no rows. Only id and text are read.
    """
    if least_length < 4 or ratio < 2:
        raise ValueError("words have at least 4 code points and forms at least twice the occurrences")
    words = checkpointed(count_words(docs, doc_id, text, least_length, least_count))
    pairs = near_pairs(words).join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    # The most frequent, and of equal ones the first in order.
    first = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("top")
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), first)
    found = words.join(near, "word", "left")
    taken = -F.col("top.less") >= ratio * F.col("n")
    found = checkpointed(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("top.other")).alias("form"), F.when(taken, -F.col("top.less")).alias("form_n")
        )
    )
    roots = follow(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
