"""Problem 9: per-document statistics and how far they lie from running prose.

Counts come from built-in functions in one scan. Per language, a robust mean and
covariance of the statistics over prose are found by concentration steps: start
at medians and quartiles, keep what is near, estimate again. Each step is one
aggregation over all documents. A short text's statistics are noisier than a
long one's: the squared deviations of what is kept are split by regression into
a part that all documents share and a part that falls with the length, so that
each document has a covariance of its own. Statistics that hardly vary among
prose keep a share of the variance they have over the whole corpus, and
languages with few documents lean on all languages together. The distance of a
document is its Mahalanobis distance under these, and splits into the
contributions of the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import materialize

# Frequent function words per language.
COMMON_WORDS = {
    "en": "the of and to a in is that it was for on with as at by not but when who if where after from since there are because why which this be have has or an they he she his her their were been will would can what how so than then into about over without against said says all no nothing everyone",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man weil wenn wer wo warum ohne gegen seit nichts ob jeder",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont l d s n qu avec son à aux mais comme on ou si leur elle ont été cette ces lui y où quand après sans contre depuis rien tout parce pourquoi dit chez entre",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante uno ni contra otros si dice nada después qué por fue es era ha",
}
# Three-letter tags of these languages.
LONG_TAGS = {"eng": "en", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr", "spa": "es"}
# Tags that name no language.
NO_LANGUAGE = ("und", "mis", "mul", "zxx")

STATS = ["common_ratio", "mean_word_len", "symbol_ratio", "digit_ratio", "bare_ratio", "marked_ratio", "field_ratio", "repeat_ratio", "end_punct_ratio"]
#: What each statistic is a mean over.
LENGTHS = ["n_words", "n_words", "n_chars", "n_chars", "n_words", "n_words", "n_words", "n_words", "n_lines"]
#: Share of a statistic's variance over the whole corpus that is no sign against a document.
SHRINKAGE = 0.1
#: Documents that all languages together count as in the model of each.
PRIOR_DOCS = 5 * len(STATS)
#: A list mark: bullet, hyphen, box, or a number or letter with a stop or bracket.
MARKER = r"^\s*([*•·▪◦‣+-]|\[[ xX]?\]|\(?([0-9]{1,3}|[a-zA-Z])[.)])\s"
#: Squared distance up to which a document takes part in the next step, and beyond which a text is no running prose: the
#: 95 % and 99.9 % quantiles of the chi-squared distribution of as many degrees of freedom as there are statistics.
NEAR, LIMIT = 16.92, 27.88
STEPS = 5


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def text_statistics(df: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str | None = "lang") -> DataFrame:
    """One row per document with a text that is not null or blank: doc_id, language, counts and STATS.

    language: a tag in `lang` (its first two or three letters) that is none of
    COMMON_WORDS stands, so that a further language is judged by its own
    documents; its common words are those of the list that fits it best. Else
    the language whose common words fill most of the text, whatever the tag
    says, as tags are often wrong; if none occurs, the tagged one, else en.

    n_chars counts characters but white space, n_words runs of letters, n_lines
    lines that are not blank. common_ratio: words that are common in the
    language; mean_word_len: letters a word; symbol_ratio, digit_ratio: of the
    characters; bare_ratio: tokens in lines of at most four words without a
    sentence's end; marked_ratio: tokens in lines that begin with a list mark (a
    dash of dialogue is none); field_ratio: separators of fields (tabs, bars, wide gaps,
    commas and semicolons without a space after them) a token; repeat_ratio:
    words equal to the word before; end_punct_ratio: lines that end in
    punctuation. Texts without words have zeros. Repeated documents come out
    once each; other columns are ignored, whatever their names.
    """
    tag = F.lower(F.regexp_extract(F.col(lang).cast("string"), r"^\s*([A-Za-z]{2,3})(?![A-Za-z])", 1)) if lang in df.columns else F.lit("")
    for long, short in LONG_TAGS.items():
        tag = F.when(tag == long, short).otherwise(tag)
    tag = F.when(~tag.isin(*NO_LANGUAGE), tag)
    d = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(tag, F.lit("")).alias("tag")).where(F.col("text").rlike(r"\S"))
    low = F.lower("text")
    d = d.withColumns({"words": F.regexp_extract_all(low, F.lit(r"[\p{L}\p{M}]+"), F.lit(0)), "lines": F.filter(F.split("text", r"[\r\n]+"), lambda x: x.rlike(r"\S"))})
    squeezed = F.regexp_replace("text", r"\s+", "")
    d = d.withColumns(
        {
            "n_words": F.size("words"), "n_lines": F.size("lines"), "n_chars": F.length(squeezed), "n_tokens": F.size(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")),
            **{f"c_{lang}": _common(lang) for lang in COMMON_WORDS},
            "n_letters": F.aggregate("words", F.lit(0), lambda acc, w: acc + F.length(w)),
            "n_symbols": F.length(F.regexp_replace(squeezed, r"[\p{L}\p{M}\p{N}\p{Z}\p{Cf}.,;:!?'\"()\-–—…«»„“”‘’¿¡]+", "")),
            "n_digits": F.length(F.regexp_replace("text", r"[^\p{N}]+", "")),
            "n_bare": F.aggregate(
                F.filter("lines", lambda x: ~x.rlike(r"[.!?…][\"'»“”’)]*\s*$") & (F.size(F.regexp_extract_all(x, F.lit(r"[\p{L}\p{M}]+"), F.lit(0))) <= 4)),
                F.lit(0), lambda acc, x: acc + F.size(F.split(F.trim(x), r"\s+")),
            ),
            "n_marked": F.aggregate(F.filter("lines", lambda x: x.rlike(MARKER)), F.lit(0), lambda acc, x: acc + F.size(F.split(F.trim(x), r"\s+"))),
            "n_fields": F.size(F.regexp_extract_all(F.trim("text"), F.lit(r"\t|\||[^\S\r\n]{3,}|[,;](?=\S)"), F.lit(0))),
            "n_ended": F.size(F.filter("lines", lambda x: x.rlike(r"\p{P}\s*$"))),
            "n_repeats": F.when(F.size("words") > 1, F.size(F.filter(F.arrays_zip(F.expr("slice(words, 2, size(words) - 1)").alias("a"), F.expr("slice(words, 1, size(words) - 1)").alias("b")), lambda z: z["a"] == z["b"]))).otherwise(0),
        }
    )
    most = F.greatest(*[F.col(f"c_{lang}") for lang in COMMON_WORDS])
    known = F.col("tag").isin(*COMMON_WORDS)
    best = F.coalesce(*[F.when(F.col(f"c_{x}") == most, F.lit(x)) for x in COMMON_WORDS])
    language = F.when((F.col("tag") != "") & ~known, F.col("tag")).when((most == 0) & known, F.col("tag")).otherwise(best)
    return d.select(
        "doc_id", language.alias("language"), "n_chars", "n_words", "n_lines",
        _ratio(most, F.col("n_words")).alias("common_ratio"), _ratio(F.col("n_letters"), F.col("n_words")).alias("mean_word_len"),
        _ratio(F.col("n_symbols"), F.col("n_chars")).alias("symbol_ratio"), _ratio(F.col("n_digits"), F.col("n_chars")).alias("digit_ratio"),
        _ratio(F.col("n_bare"), F.col("n_tokens")).alias("bare_ratio"), _ratio(F.col("n_marked"), F.col("n_tokens")).alias("marked_ratio"), F.least(_ratio(F.col("n_fields"), F.col("n_tokens")), F.lit(1.0)).alias("field_ratio"),
        _ratio(F.col("n_repeats"), F.col("n_words")).alias("repeat_ratio"), _ratio(F.col("n_ended"), F.col("n_lines")).alias("end_punct_ratio"),
    )


def _common(lang: str) -> Column:
    words = list(dict.fromkeys(COMMON_WORDS[lang].split()))
    return F.size(F.filter("words", lambda w: w.isin(words)))


#: Per language the centre, the covariance that all its prose shares, and the variance that one unit of length adds; "" is all languages.
Models = dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]


def _parts(x: np.ndarray, length: np.ndarray, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The statistics' parts of the squared distance of each row, under the covariance for its length."""
    centre, shared, noise = model
    own = np.broadcast_to(shared, (len(x), *shared.shape)).copy()
    at = np.arange(x.shape[1])
    own[:, at, at] += noise / np.maximum(length, 1)
    off = x - centre
    return off * np.linalg.solve(own, off[:, :, None])[:, :, 0]


def _columns(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.stack([b.column(s).to_numpy() for s in STATS], axis=1)
    return x, np.stack([b.column(c).to_numpy() for c in LENGTHS], axis=1).astype(float), b.column("language").to_numpy(zero_copy_only=False)


def correlation(cov: np.ndarray) -> np.ndarray:
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-18))
    corr = cov / np.outer(sd, sd)
    np.fill_diagonal(corr, 1.0)
    return corr


class _Sums:
    """What the moments need of the documents kept, as one vector that adds up: n, x, xx', and with u = 1 / length: u, uu, xu, xxu."""

    k = len(STATS)
    size = 1 + k + k * k + 4 * k

    @classmethod
    def of(cls, x: np.ndarray, length: np.ndarray) -> np.ndarray:
        u = 1 / np.maximum(length, 1)
        return np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel(), u.sum(0), (u * u).sum(0), (x * u).sum(0), (x * x * u).sum(0)])

    @classmethod
    def model(cls, total: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centre, shared covariance and noise of the summed documents. floor: variances added to the shared covariance."""
        k, n = cls.k, total[0]
        mean = total[1 : k + 1] / n
        cov = total[k + 1 : k + 1 + k * k].reshape(k, k) / n - np.outer(mean, mean)
        u, uu, xu, xxu = (total[1 + k + k * k + i * k :][:k] / n for i in range(4))
        var = np.maximum(np.diag(cov), 0)
        # Regression of the squared deviations on 1 / length.
        spread = np.maximum(uu - u * u, 1e-15)
        noise = np.maximum((xxu - 2 * mean * xu + mean * mean * u - var * u) / spread, 0)
        shared = var - noise * u
        noise, shared = np.where(shared < 0, var / np.maximum(u, 1e-12), noise), np.maximum(shared, 0)
        return mean, correlation(cov) * np.sqrt(np.outer(shared, shared)) + np.diag(floor), noise


def prose_models(stats: DataFrame) -> Models:
    """Robust centre, shared covariance and length noise of the statistics of each language's prose."""
    quartiles = [F.percentile_approx(s, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(s) for s in STATS]
    # One row per language: a tag has two or three letters.
    start = stats.groupBy("language").agg(F.count("*").alias("n"), *quartiles).collect()
    if not start:
        return {}
    whole = stats.agg(*quartiles, *[F.var_pop(s).alias(f"{s}_var") for s in STATS]).first()
    # A statistic that is the same in all documents tells nothing.
    floor = np.maximum(SHRINKAGE * np.array([whole[f"{s}_var"] for s in STATS]), 1e-9)

    def rough(r) -> tuple[np.ndarray, np.ndarray]:
        q = np.array([r[s] for s in STATS])
        return q[:, 1], ((q[:, 2] - q[:, 0]) / 1.349) ** 2

    models: Models = {}
    for r in start:
        own = r["n"] / (r["n"] + PRIOR_DOCS)
        centre, var = (own * a + (1 - own) * b for a, b in zip(rough(r), rough(whole)))
        models[r["language"]] = centre, np.diag(var + floor), np.zeros(len(STATS))

    names = [f"m{i}" for i in range(_Sums.size)]
    for _ in range(STEPS):

        def moments(batches: Iterator[pa.RecordBatch], now: Models = models) -> Iterator[pa.RecordBatch]:
            total: dict[str, np.ndarray] = {}
            for b in batches:
                x, length, lang = _columns(b)
                for name in set(lang.tolist()):
                    rows = lang == name
                    y, m = x[rows], length[rows]
                    near = _parts(y, m, now[name]).sum(axis=1) <= NEAR
                    total[name] = total.get(name, 0) + _Sums.of(y[near], m[near])
            if total:
                cols = [pa.array(list(total))] + [pa.array(c) for c in np.stack(list(total.values())).T]
                yield pa.RecordBatch.from_arrays(cols, names=["language", *names])

        part = stats.select("language", *dict.fromkeys(LENGTHS), *STATS).mapInArrow(moments, "language string, " + ", ".join(f"{c} double" for c in names))
        sums = {r["language"]: np.array([r[c] for c in names]) for r in part.groupBy("language").agg(*[F.sum(c).alias(c) for c in names]).collect()}
        every = sum(sums.values())
        if every[0] == 0:
            break
        models = {name: _Sums.model(sums[name] + PRIOR_DOCS * every / every[0], floor) for name in models}
    return models


def with_distance(stats: DataFrame, models: Models) -> DataFrame:
    """stats with distance2, the squared Mahalanobis distance from the language's prose, and per statistic its part of it."""
    extra = [f"{s}_part" for s in STATS] + ["distance2"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, length, lang = _columns(b)
            parts = np.zeros_like(x)
            for name in set(lang.tolist()):
                rows = lang == name
                parts[rows] = _parts(x[rows], length[rows], models[name])
            added = [pa.array(c) for c in parts.T] + [pa.array(parts.sum(axis=1))]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], names=[*b.schema.names, *extra])

    kind = T.StructType([*stats.schema.fields, *[T.StructField(c, T.DoubleType()) for c in extra]])
    return stats.mapInArrow(measure, kind)


def text_quality(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str | None = "lang", limit: float = LIMIT) -> DataFrame:
    """text_statistics with the distance from prose, its parts and is_prose. An empty table gives an empty result."""
    stats = materialize(text_statistics(documents, text, doc_id, lang), "stats")
    return with_distance(stats, prose_models(stats)).withColumn("is_prose", F.col("distance2") <= limit)
