"""Entity resolution: exact, alias and fuzzy tiers, ambiguity to review; ranking of registrations."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import token_set_ratio
from ..session import cut, spread

# Fixed values of the resolver.
FUZZY_ACCEPT, FUZZY_LEAD = 93.0, 3.0
CANDIDATE_SCORE, CANDIDATES = 60.0, 10
MODEL_ACCEPT = 0.9
# Registration types that can issue a listed security; the foreign type's number is of another register.
LISTABLE_TYPES, FOREIGN_TYPE = ("APUB", "FNOS", "CCIV"), "FNOS"


def unique_match(names: DataFrame, pool: DataFrame, norm: str, entity: str, out: str) -> DataFrame:
    """``names`` with the only entity that has the name (null otherwise) and whether several have it."""
    found = pool.groupBy(F.col(norm)).agg(F.min(entity).alias("__low"), F.max(entity).alias("__high"))
    hit = F.when(F.col("__low") == F.col("__high"), F.col("__low"))
    return names.join(found, norm, "left").withColumn(out, hit).withColumn(f"{out}_collides", F.coalesce(F.col("__low") != F.col("__high"), F.lit(False))).drop("__low", "__high")


def _in_parts(left: DataFrame, right: DataFrame, norm: str, key: str, hot: int) -> DataFrame:
    """Pairs (norm, __other) with an equal key; a key of many names of the right side is split into parts of about ``hot``."""
    size = right.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / hot).cast("int").alias("__parts"))
    asked = left.join(size, key).select(norm, key, F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"))
    blocks = right.join(size, key).select("__other", key, F.pmod(F.xxhash64("__other"), F.col("__parts")).cast("int").alias("__part"))
    return asked.join(blocks, [key, "__part"]).select(norm, "__other")


def fuzzy_scores(names: DataFrame, pool: DataFrame, norm: str, entity: str, hot: int = 10_000, least: float = CANDIDATE_SCORE) -> DataFrame:
    """norm, entity, score: all pairs whose token-set similarity is ``least`` or more.

    No pair is lost.  With s = least / 100, |x| the length of the tokens of x joined by spaces:

    - A score by the shared tokens (these with or without the rest of one side) needs shared
      tokens of length s |x| / (2 - s) for one of the two names x, so its tokens that aren't
      shared have a length of at most |x| (1 - s / (2 - s)) together, a space each included.  Of
      the rarest tokens of x that are longer than that together one is shared.
    - A score of both wholes allows d = (1 - s) (|x| + |y|) insertions and deletions.  Each
      takes at most two letter pairs from a name (pairs within a token and at its ends, so
      their order doesn't matter).  Of the 2 d + 1 rarest pairs of each one is shared.

    So names meet by their rarest tokens and letter pairs alone, and words that most names hold
    make no block unless a name has no others.
    """
    s = least / 100
    squeezed = F.trim(F.regexp_replace(F.col(norm), r"\s+", " "))
    whole = F.array_join(F.array_distinct(F.split(squeezed, " ")), " ")
    rows = lambda df: df.select(norm).distinct().withColumn("__whole", whole).where("__whole != ''").withColumn("__size", F.length("__whole"))
    left, right = rows(names), rows(pool).withColumnRenamed(norm, "__other")
    by_rarity = lambda key, name: Window.partitionBy(name).orderBy(F.coalesce("__n", F.lit(0)), key)

    def tokens(df: DataFrame, name: str) -> DataFrame:
        return df.select(name, "__size", F.explode(F.split("__whole", " ")).alias("__token"))

    def rarest_tokens(df: DataFrame, name: str) -> DataFrame:
        told = df.join(often_tokens, "__token", "left")
        before = F.sum(F.length("__token") + 1).over(by_rarity("__token", name).rowsBetween(Window.unboundedPreceding, -1))
        return told.withColumn("__before", F.coalesce(before, F.lit(0))).where(F.col("__before") <= F.col("__size") * (1 - s / (2 - s)) + 1e-9).select(name, "__token")

    left_tokens, right_tokens = tokens(left, norm), tokens(right, "__other")
    often_tokens = right_tokens.groupBy("__token").agg(F.count(F.lit(1)).alias("__n"))
    by_token = _in_parts(rarest_tokens(left_tokens, norm), right_tokens.select("__other", "__token"), norm, "__token", hot)
    by_token = by_token.unionByName(_in_parts(left_tokens.select(norm, "__token"), rarest_tokens(right_tokens, "__other"), norm, "__token", hot))

    def letters(df: DataFrame, name: str) -> DataFrame:
        padded = F.concat(F.lit(" "), F.col("__whole"), F.lit(" "))
        pairs = F.transform(F.sequence(F.lit(1), F.col("__size") + 1), lambda i: F.substring(padded, i, F.lit(2)))
        some = df.select(name, "__size", F.explode(pairs).alias("__pair")).groupBy(name, "__size", "__pair").agg(F.count(F.lit(1)).alias("__times"))
        return some.select(name, "__size", F.explode(F.transform(F.sequence(F.lit(1), F.col("__times").cast("int")), lambda i: F.concat("__pair", i.cast("string")))).alias("__gram"))

    def rarest_letters(df: DataFrame, name: str) -> DataFrame:
        # the other name is at most 1 / s - ... as long: |y| <= |x| (2 - s) / s
        most = F.floor((1 - s) * F.col("__size") * (1 + (2 - s) / s) + 1e-9)
        told = df.join(often_letters, "__gram", "left").withColumn("__nr", F.row_number().over(by_rarity("__gram", name)))
        return told.where(F.col("__nr") <= 2 * most + 1).select(name, "__gram")

    left_letters, right_letters = letters(left, norm), letters(right, "__other")
    often_letters = right_letters.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    by_letter = _in_parts(rarest_letters(left_letters, norm), rarest_letters(right_letters, "__other"), norm, "__gram", hot)
    sizes = left.select(norm, "__size"), right.select("__other", F.col("__size").alias("__other_size"))
    near = F.abs(F.col("__size") - F.col("__other_size")) <= (1 - s) * (F.col("__size") + F.col("__other_size")) + 1e-9
    by_letter = by_letter.distinct().join(sizes[0], norm).join(sizes[1], "__other").where(near).select(norm, "__other")
    pairs = by_token.unionByName(by_letter).distinct()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(score=[token_set_ratio(a, b) for a, b in zip(batch[norm], batch["__other"])])

    scored = pairs.mapInPandas(score, f"{norm} string, __other string, score double").where(F.col("score") >= least)
    owners = pool.select(F.col(norm).alias("__other"), entity).distinct()
    return scored.join(owners, "__other").groupBy(norm, entity).agg(F.max("score").alias("score"))


#: Counters of tokens and letter pairs; these share one where their hashes do.
_COUNTERS = 1 << 18
#: The score that a first search asks for: who has one match above it, and no other within the lead, needs no wider search.
_CLOSE = 100.0 - FUZZY_LEAD


def _tokens(name: str | None) -> list[str]:
    return sorted(set((name or "").split()))


def _letter_pairs(whole: str) -> list[str]:
    """The letter pairs of a name, ends included; a pair that comes again has its number, so lists compare as sets."""
    padded, times = f" {whole} ", {}
    out = []
    for i in range(len(padded) - 1):
        pair = padded[i : i + 2]
        times[pair] = nr = times.get(pair, 0) + 1
        out.append(f"{pair}{nr}")
    return out


def _counter(kind: bytes, what: str) -> int:
    return zlib.crc32(kind + what.encode("utf-8", "surrogatepass")) & (_COUNTERS - 1)


def _how_often(pool: DataFrame, norm: str) -> np.ndarray:
    """How many names hold the tokens and letter pairs of each counter."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(_COUNTERS, dtype=np.int64)
        for batch in batches:
            for tokens in map(_tokens, batch[norm]):
                np.add.at(n, [*(_counter(b"t", t) for t in tokens), *(_counter(b"p", p) for p in _letter_pairs(" ".join(tokens)))], 1)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"at": at, "n": n[at]})

    out = np.zeros(_COUNTERS, dtype=np.int64)
    found = pool.mapInPandas(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # a row a counter at most
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return out


@lru_cache(100_000)
def _lost(size: int, s: float) -> int:
    """How many of its letter pairs a name of this size may lack in another whose ratio to it is s or more.

    A letter that the other lacks takes two pairs, one that it has more takes one; with a of the former and b of the latter
    s allows a (2 - s) + b s <= 2 (1 - s) size.
    """
    allowed = 2 * (1 - s) * size + 1e-9
    return max(2 * a + int((allowed - a * (2 - s)) / s) for a in range(int(allowed / (2 - s)) + 1))


@lru_cache(100_000)
def _class_of(size: int, s: float) -> tuple[int, int]:
    """A class of sizes, and how many letter pairs must meet at once in it: more where few may be lacking."""
    top = 8
    while top < size:
        top = top * 3 // 2
    lost = _lost(top, s)
    return top, 3 if lost <= 8 else 2 if lost <= 16 else 1


def _meeting(name: str | None, s: float, least: float, often: np.ndarray, asks: bool) -> list[tuple[int, int, int]]:
    """(key, class or 0 for tokens, need) of a name.  Two names of score s or more have an equal key, for any s of ``least`` or more.

    Tokens: see ``fuzzy_scores``; one side's rarest meet all of the other.  Letter pairs: if c of them are shared, the c that are rarest of
    these are among the first lost + c of either name in any order that both follow, so names meet by c pairs at once.
    ``need`` is how many pairs a name lacks before the last of them.  With s of 0.9 at least, three are always shared.
    """
    tokens = _tokens(name)
    if not tokens:
        return []
    size, out, before = sum(map(len, tokens)) + len(tokens) - 1, [], 0
    hashed = lambda what, seed: np.int64(np.uint64(xxhash.xxh3_64_intdigest(what.encode("utf-8", "surrogatepass"), seed)).view(np.int64))
    for token in sorted(tokens, key=lambda t: (often[_counter(b"t", t)], t)):
        rare = before <= size * (1 - s / (2 - s)) + 1e-9
        out += [(hashed(token, 1 + (asks != rarest)), 0, 0) for rarest in ((True, False) if rare else (False,))]
        before += len(token) + 1
    lost = _lost(size, s)
    if not lost:  # the same tokens then
        return out
    pairs = sorted(_letter_pairs(" ".join(tokens)), key=lambda p: (often[_counter(b"p", p)], p))
    classes = {_class_of(size, least)} if asks else {_class_of(n, least) for n in range(max(1, int(size * s / (2 - s))), int(size * (2 - s) / s) + 2)}
    for top, c in classes:
        for some in combinations(range(min(lost + c, len(pairs))), c):
            out.append((hashed("\n".join(pairs[i] for i in some), 3 + top), top, some[-1] + 1 - c))
    return out


def _two_best(todo: DataFrame, rivals: DataFrame, owners: DataFrame, norm: str, entity: str, often, least: float, hot: int) -> DataFrame:
    """norm, __best, __score, __second: the best entity and the score of the next one, of all whose score is ``__least`` or more.

    ``rivals``: __other, the distinct names of the pool; ``owners``: __other, entity, the two lowest of each.
    """

    def keys(name: str, asks: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), 500):
                    part = batch.iloc[at : at + 500]
                    rows = [(n, b, *k) for n, b in zip(part[name], part["__least"]) for k in _meeting(n, b / 100, least / 100, often.value, asks)]
                    yield pd.DataFrame(rows, columns=[name, "__least", "__key", "__class", "__need"])

        return run

    columns = "__least double, __key long, __class int, __need int"
    size = lambda c: F.length(F.array_join(F.array_distinct(F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " ")), " "))
    left = spread(todo.select(norm, "__least")).mapInPandas(keys(norm, True), f"{norm} string, {columns}").drop("__need", "__class")
    right = spread(rivals.withColumn("__least", F.lit(least))).mapInPandas(keys("__other", False), f"__other string, {columns}").drop("__least")
    right = right.withColumn("__other_size", size("__other"))
    parts = right.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot).select("__key", F.ceil(F.col("__n") / hot).cast("int").alias("__parts"))
    one = F.coalesce("__parts", F.lit(1))
    left = left.join(parts, "__key", "left").withColumn("__part", F.explode(F.sequence(F.lit(0), one - 1))).drop("__parts").withColumn("__size", size(norm))
    right = right.join(parts, "__key", "left").withColumn("__part", F.pmod(F.xxhash64("__other"), one).cast("int")).drop("__parts")
    slack = 1 - F.col("__least") / 100
    near = F.abs(F.col("__size") - F.col("__other_size")) <= slack * (F.col("__size") + F.col("__other_size")) + 1e-9
    near = near & (F.col("__need") <= 4 * slack * F.col("__other_size") / (1 + slack) + 1e-9)
    pairs = left.join(right, ["__key", "__part"]).where((F.col("__class") == 0) | near).select(norm, "__other", "__least").distinct()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(score=[token_set_ratio(a, b) for a, b in zip(batch[norm], batch["__other"])])

    scored = pairs.mapInPandas(score, f"{norm} string, __other string, __least double, score double").where("score >= __least")
    each = scored.join(owners, "__other").groupBy(norm, entity).agg(F.max("score").alias("score"))
    order = Window.partitionBy(norm).orderBy(F.col("score").desc(), entity)
    return each.withColumn("__nr", F.row_number().over(order)).where("__nr <= 2").groupBy(norm).agg(F.max(F.when(F.col("__nr") == 1, F.col(entity))).alias("__best"), F.max("score").alias("__score"), F.max(F.when(F.col("__nr") == 2, F.col("score"))).alias("__second"))


def fuzzy_best(names: DataFrame, pool: DataFrame, norm: str, entity: str, hot: int = 10_000) -> DataFrame:
    """norm, __best, __score, __second of each distinct name: enough to accept or refuse its best entity, without all pairs.

    Names are searched at the narrowest score that can settle them.  Any pair within it is found, so a second
    entity there settles a name, and so does a best one that leads all that the search leaves out; others are searched again, down to
    FUZZY_LEAD below their best, or at FUZZY_ACCEPT where they have none.  Three searches at most.
    """
    rivals = cut(pool.select(F.col(norm).alias("__other")).where(F.col(norm).isNotNull()).distinct())
    often = pool.sparkSession.sparkContext.broadcast(_how_often(rivals.withColumnRenamed("__other", norm), norm))
    lowest = Window.partitionBy("__other").orderBy(entity)
    owners = pool.select(F.col(norm).alias("__other"), entity).distinct().withColumn("__nr", F.row_number().over(lowest)).where("__nr <= 2").drop("__nr")
    todo, least, out = cut(names.select(norm).where(F.col(norm).isNotNull()).distinct().withColumn("__least", F.lit(_CLOSE))), _CLOSE, None
    while least is not None:
        found = cut(todo.join(_two_best(todo, rivals, owners, norm, entity, often, least, hot), norm, "left"))
        alone, none = F.col("__score").isNotNull() & F.col("__second").isNull(), F.col("__score").isNull()
        again = (alone & (F.col("__score") - FUZZY_LEAD < F.col("__least"))) | (none & (F.col("__least") > FUZZY_ACCEPT))
        done = found.where(~again).select(norm, "__best", "__score", F.coalesce("__second", F.lit(0.0)).alias("__second"))
        out = done if out is None else out.unionByName(done)
        # a hair lower, so that rounding leaves none out
        todo = found.where(again).select(norm, F.when(none, FUZZY_ACCEPT).otherwise(F.col("__score") - FUZZY_LEAD - 1e-6).alias("__least"))
        least = todo.agg(F.min("__least")).first()[0]
    return out


def resolve(names: DataFrame, pool: DataFrame, aliases: DataFrame, norm: str, entity: str, model: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """norm, entity, method, confidence of each distinct name.

    Exact, then alias; several entities at either tier are a collision and go to review.  Then
    the best fuzzy score over all names of the pool, if it clears the bar and leads the best other entity; then ``model``
    (norm, entity, score of the ten best candidates -> norm, entity, confidence); else review.
    ``pool`` holds all names, former ones too.
    """
    distinct = names.select(norm).distinct()
    tiers = unique_match(distinct, pool, norm, entity, "__exact")
    tiers = unique_match(tiers, aliases, norm, entity, "__alias")
    blank = F.coalesce(F.col(norm), F.lit("")) == ""
    settled = ~blank & (F.col("__exact").isNotNull() | F.col("__exact_collides") | F.col("__alias").isNotNull() | F.col("__alias_collides"))
    open_ = tiers.where(~settled & ~blank).select(norm)
    if model is None:
        best = fuzzy_best(open_, pool, norm, entity)
    else:
        scores = fuzzy_scores(open_, pool, norm, entity, least=CANDIDATE_SCORE)
        order = Window.partitionBy(norm).orderBy(F.col("score").desc(), entity)
        ranked = scores.withColumn("__nr", F.row_number().over(order))
        best = ranked.groupBy(norm).agg(F.max(F.when(F.col("__nr") == 1, F.col(entity))).alias("__best"), F.max("score").alias("__score"), F.coalesce(F.max(F.when(F.col("__nr") == 2, F.col("score"))), F.lit(0.0)).alias("__second"))
    accept = (F.col("__score") >= FUZZY_ACCEPT) & (F.col("__score") - F.col("__second") >= FUZZY_LEAD)
    best = best.withColumn("__fuzzy", F.when(accept, F.col("__best")))
    out = tiers.join(best, norm, "left")
    if model is not None:
        said = model(ranked.where((F.col("__nr") <= CANDIDATES) & (F.col("score") >= CANDIDATE_SCORE)).select(norm, entity, "score"))
        out = out.join(said.select(norm, F.col(entity).alias("__model"), F.col("confidence").alias("__sure")), norm, "left")
    else:
        out = out.withColumn("__model", F.lit(None).cast(pool.schema[entity].dataType)).withColumn("__sure", F.lit(None).cast("double"))
    modelled = F.col("__model").isNotNull() & (F.col("__sure") >= MODEL_ACCEPT)
    method = (
        F.when(blank, "review").when(F.col("__exact").isNotNull(), "exact").when(F.col("__exact_collides"), "review")
        .when(F.col("__alias").isNotNull(), "alias").when(F.col("__alias_collides"), "review")
        .when(F.col("__fuzzy").isNotNull(), "fuzzy").when(modelled, "model").otherwise("review")
    )
    out = out.withColumn("method", method)
    pick = F.when(F.col("method") == "exact", F.col("__exact")).when(F.col("method") == "alias", F.col("__alias")).when(F.col("method") == "fuzzy", F.col("__fuzzy")).when(F.col("method") == "model", F.col("__model"))
    sure = F.when(F.col("method").isin("exact", "alias"), F.lit(1.0)).when(F.col("method") == "fuzzy", F.col("__score") / 100).when(F.col("method") == "model", F.col("__sure")).otherwise(0.0)
    return out.select(norm, pick.alias(entity), "method", sure.alias("confidence"))


def learned_aliases(resolved: DataFrame, norm: str, entity: str) -> DataFrame:
    """What fuzzy and model matches add to the alias table."""
    return resolved.where(F.col("method").isin("fuzzy", "model")).select(norm, entity, "method", "confidence")


def rank_registrations(names: DataFrame, registry: DataFrame, norm: str, listed_only: bool = True) -> DataFrame:
    """norm, number, basis, is_foreign: the registration that a name means.

    Holders of the name today: the only one, else the only one not deregistered, else none.
    Former names count only if nobody holds the name today, and only if one company had it.
    ``registry``: norm, number, company_type, is_current_name, deregistration_date.
    """
    rows = registry.where(F.col("company_type").isin(*LISTABLE_TYPES)) if listed_only else registry
    only = lambda where: F.when(F.min(F.when(where, F.col("number"))) == F.max(F.when(where, F.col("number"))), F.min(F.when(where, F.col("number"))))
    now = F.col("is_current_name")
    tiers = rows.groupBy(norm).agg(
        F.max(now.cast("int")).alias("__held"),
        only(now).alias("__current"),
        only(now & F.col("deregistration_date").isNull()).alias("__live"),
        only(F.lit(True)).alias("__former"),
    )
    out = names.select(norm).distinct().join(tiers, norm, "left")
    held = F.coalesce(F.col("__held") == 1, F.lit(False))
    basis = F.when(F.col("__current").isNotNull(), "current_name").when(held & F.col("__live").isNotNull(), "current_name_live").when(~held & F.col("__former").isNotNull(), "former_name").otherwise("none")
    out = out.withColumn("basis", basis).withColumn("number", F.when(F.col("basis") == "current_name", F.col("__current")).when(F.col("basis") == "current_name_live", F.col("__live")).when(F.col("basis") == "former_name", F.col("__former")))
    kinds = rows.groupBy(norm, "number").agg(F.max((F.col("company_type") == FOREIGN_TYPE).cast("int")).alias("__foreign"))
    return out.join(kinds, [norm, "number"], "left").select(norm, "number", "basis", (F.coalesce(F.col("__foreign"), F.lit(0)) == 1).alias("is_foreign"))


def attach_numbers(entities: DataFrame, extract: DataFrame, key: str, number: str) -> DataFrame:
    """``entities`` with the extract's number where they have none; a different one is a conflict and isn't taken."""
    seen = extract.join(entities.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi").groupBy(key).agg(F.max(number).alias("__new"))
    out = entities.join(seen, key, "left")
    what = F.when(F.col("__new").isNull(), "absent").when(F.col(number).isNull(), "updated").when(F.col(number) == F.col("__new"), "same").otherwise("conflict")
    return out.withColumn("outcome", what).withColumn(number, F.coalesce(F.col(number), F.col("__new"))).drop("__new")
