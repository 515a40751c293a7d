"""Operator 3: secrets in texts, with a random forest that takes out false positives. Native: no Python on executors.

Candidates are keys of issued formats wherever they stand, values of at least 6 characters without white space that an
announcing name is assigned, and runs of at least 16 key characters. Each is described by its length, the transitions between character
classes, the share of its letters that dictionary words cover, the path of its document and the words around it. A
random forest trained on labelled findings decides. Labelled findings can be passed in; otherwise they are taken from
the scanned candidates themselves by `labelled_by_evidence`, as many distinct vectors as `train_rows` at most.

Null and empty texts and empty tables have no candidates; a null path counts as an empty one. Rows are told apart by their place in
the files, so equal rows, rows with the same id and rows without one are each scanned. Texts are scanned whole, of any length. Candidates
never overlap: the leftmost begins first, an issued format before an assigned value before a run. Further columns are kept, and
names that clash with those used here do no harm.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

import public_tokenizers

from carelake.llm.common import free_name, let, located, text_of, written

DICTIONARY = "word_bpe_49k.json"
REDACTED = "[SECRET]"
#: The forest is fitted on at most so many distinct vectors of labelled findings, half of each label.
TRAIN_ROWS = 8000
TREES, DEPTH, SEED = 40, 8, 11
#: A value in so many different surroundings is no secret.
MANY_CONTEXTS = 4
#: A value's findings are spread over so many keys in the join with the common ones.
SALTS = 32
#: Code points kept of the text before and after a candidate.
BEFORE, AFTER = 48, 16

# What a candidate looks like, the words that announce a secret, formats of issued keys, paths of samples.
NAMES = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credentials?)"
ASSIGNED = r"[\"']?[ \t]{0,4}(=|:|=>|:=)[ \t]{0,4}[\"']?$"
_KEYS = r"(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_(?:live|test)_[A-Za-z0-9]{16,}+|xox[abp]-[0-9A-Za-z-]{10,}+)"
ISSUED = f"^{_KEYS}$"
_ISSUED_HERE = rf"(?<![A-Za-z0-9]){_KEYS}(?![A-Za-z0-9])"
# An announcing name that ends as a word does ("author" and "passage" announce nothing), and its assignment, before a value.
_ANNOUNCED = (
    r"(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credentials?)"
    r"(?:s|[0-9_ ][A-Za-z0-9_ ]{0,11}|(?<=[a-z])[A-Z][A-Za-z0-9_ ]{0,11})?[\"']?[ \t]{0,4}(?::=|=>|=|:)[ \t]{0,4}[\"']?")
# Where an unquoted value ends: at white space or a quote, before closing punctuation, a closing tag, the next parameter.
_VALUE = r"(?:(?![,;.)\]}]{1,4}(?:[\s\"'`<]|$)|</|&\w{1,40}=|" + _ISSUED_HERE + r")[^\s\"'`]){6,}+"
_KEY_CHARACTER = r"[A-Za-z0-9_+/\-]"
# Groups that repeat are possessive: Java then walks a long text in a loop. A run may begin where a key of an issued format ended.
CANDIDATE = (
    rf"{_ISSUED_HERE}"
    rf"|(?<=[=:>\"' \t])(?<=[=:>][ \t]{{0,4}}[\"']?)(?<={_ANNOUNCED}){_VALUE}"
    rf"|(?:\G|(?<!{_KEY_CHARACTER}))(?={_KEY_CHARACTER}{{16}})(?:(?!{_ISSUED_HERE}){_KEY_CHARACTER}){{16,}}+(?:={{1,2}}(?![A-Za-z0-9]))?")
# Short values of a name that are no secret: a word, a placeholder, a reference or call in code, an address.
PLAIN = (
    r"^(?:[A-Za-z]{1,15}|[*.\u2022xX_\-]+|[$%]?[{<(\[].*|%[A-Z_]+%|\$[A-Z_]+"
    r"|[A-Za-z_]\w*(?:(?:\.|::|->)[A-Za-z_]\w*)*[(\[].*|[A-Za-z_]+(?:(?:\.|::|->)[A-Za-z_]+)+|https?://[^@]*)$")
SAMPLE_PATH = r"(?i)(test|example|sample|doc|fixture|vendor)"
VOWELS, CONSONANTS = "aeiou", "bcdfghjklmnpqrstvwxyz"
_FROM = VOWELS + CONSONANTS + VOWELS.upper() + CONSONANTS.upper() + "0123456789_+/-="
_TO = "v" * 5 + "c" * 21 + "V" * 5 + "C" * 21 + "d" * 10 + "s" * 5
# Transitions between classes (vowel, consonant; capitals; digit; other) that become features.
TRANSITIONS = {
    "letter_digit": "(?=[vcVC]d|d[vcVC])", "digit_digit": "(?=dd)", "case_change": "(?=[vc][VC]|[VC][vc])",
    "vowel_consonant": "(?=[vV][cC]|[cC][vV])", "consonants": "(?=[cC][cC])", "consonant_run": "(?=[cC]{4})",
    "vowels": "(?=[vV][vV])", "other": "(?=s)",
}
KEY = ("file", "row", "pos")


def candidates(docs: DataFrame, at: str, text_col: str, path_col: str | None) -> DataFrame:
    """One row per candidate: file, row, pos (its number), start, length, candidate, before, after, path.

    `start` counts code points from 0. Null texts have none.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    text = text_of(text_col)

    def found(gaps: Column) -> Column:
        # the name of a value may be a candidate itself, so the one before belongs to the text before
        return let(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), lambda all_: F.transform(
            all_, lambda c, i: F.struct(
                i.alias("pos"), c.alias("candidate"), F.length(gaps[i]).alias("gap"),
                F.right(F.concat(F.when(i > 0, all_[F.greatest(i - 1, F.lit(0))]).otherwise(""), gaps[i]), F.lit(BEFORE)).alias("before"),
                F.left(gaps[i + 1], F.lit(AFTER)).alias("after"))))

    rows = docs.filter(text.rlike(CANDIDATE)).select(
        F.col(f"{at}.file").alias("file"), F.col(f"{at}.row").alias("row"), path.alias("path"),
        F.explode(let(F.split(text, CANDIDATE, -1), found)).alias("c"),
    ).select("file", "row", "path", "c.*")
    # ordered by position within one document: its candidates only
    own = Window.partitionBy("file", "row").orderBy("pos")
    length = F.length("candidate").cast("bigint")
    return rows.withColumn("length", length).withColumn(
        "start", F.sum(F.col("gap") + F.col("length")).over(own) - F.col("length")).drop("gap")


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(word): the whole words of at least four letters in a public tokenizer's vocabulary, bounded by that file."""
    vocabulary = spark.read.text(f"file://{path}", wholetext=True).select(
        F.explode(F.map_keys(F.from_json(F.get_json_object("value", "$.model.vocab"), "map<string,int>"))).alias("v"))
    return vocabulary.filter(F.col("v").rlike("^[a-z]{4,}</w>$")).select(F.regexp_replace("v", "</w>", "").alias("word"))


def features(found: DataFrame, words: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """The candidates with the numbers the forest sees, in `FEATURES`."""
    kinds = F.translate("candidate", _FROM, _TO)
    n = F.length("candidate")
    share = {name: F.regexp_count(kinds, F.lit(p)) / n for name, p in TRANSITIONS.items()}
    runs = found.select(*key, F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{4,}"), F.lit(0))).alias("word"))
    # the dictionary is bounded by its vocabulary file, 49,408 entries
    covered = runs.join(F.broadcast(words), "word").groupBy(*key).agg(F.sum(F.length("word")).alias("known"))
    numbers = {
        "n": n.cast("double"), **share,
        "digits": F.regexp_count(kinds, F.lit("d")) / n,
        "capitals": F.regexp_count(kinds, F.lit("[VC]")) / n,
        "distinct": F.size(F.array_distinct(F.split("candidate", ""))) / n,
        "hex": F.col("candidate").rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "issued": F.col("candidate").rlike(ISSUED).cast("double"),
        "named": F.col("before").rlike(NAMES + r"[A-Za-z0-9_ ]{0,12}" + ASSIGNED).cast("double"),
        "assigned": F.col("before").rlike(ASSIGNED).cast("double"),
        "quoted": (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"),
        "prose_before": F.col("before").rlike(r"\p{L}{2,}[,.]? $").cast("double"),
        "prose_after": F.col("after").rlike(r"^[,.]? \p{L}{2,}").cast("double"),
        "plain": F.col("candidate").rlike(PLAIN).cast("double"),
        "sample_path": F.col("path").rlike(SAMPLE_PATH).cast("double"),
    }
    return found.withColumns(numbers).join(covered, list(key), "left").withColumn(
        "dictionary", F.coalesce("known", F.lit(0)) / n).drop("known")


FEATURES = (
    "n", *TRANSITIONS, "digits", "capitals", "distinct", "hex", "issued", "named", "assigned", "quoted",
    "prose_before", "prose_after", "plain", "sample_path", "dictionary",
)
#: Features that labels by evidence are also told by.
TELLING = ("issued", "named", "assigned", "quoted", "plain")


def labelled_by_evidence(found: DataFrame) -> DataFrame:
    """Labelled findings, `label` 1 a secret, from evidence that no feature holds where it can be had.

    Keys of issued formats are secrets: 1. Any other value met in `MANY_CONTEXTS` different surroundings is common knowledge, whatever
    announces it: 0. Of the rest, mixed values of an announcing name are secrets: 1; plain values of a name are not, nor is what no name
    announces and is all letters or all digits: 0. Mixed values that nothing announces stay without label: the forest judges them by their
    characters. Copies of a document are one surrounding, so copied secrets are not common.
    """
    named = F.col("before").rlike(NAMES + r"[A-Za-z0-9_ ]{0,12}" + ASSIGNED)
    mixed = F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]")
    issued = F.col("candidate").rlike(ISSUED)
    plain = F.col("candidate").rlike(PLAIN)
    # a value may own a third of all findings: counted by a bounded sketch in each map task, joined over salts
    common = found.groupBy(F.col("candidate").alias("_value")).agg(
        F.approx_count_distinct(F.xxhash64("before", "after")).alias("_contexts")).filter(F.col("_contexts") >= MANY_CONTEXTS)
    common = common.select("_value", F.lit(True).alias("_common"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_at"))
    salt = F.pmod(F.xxhash64(*KEY), F.lit(SALTS)).cast("int")
    told = found.join(common, (F.col("candidate") == F.col("_value")) & (salt == F.col("_at")), "left")
    label = F.when(issued, 1.0).when(F.col("_common"), 0.0).when(named & mixed & ~plain, 1.0).when(plain | (~named & ~mixed), 0.0)
    return told.select(*found.columns, label.alias("label")).filter("label is not null")


def withheld(known: DataFrame) -> DataFrame:
    """The labelled findings, and each again without the features that its label may come from, so that the forest has to
    judge values by their characters and words as well."""
    return known.unionByName(known.withColumns({name: F.lit(0.0) for name in TELLING}))


def sample(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """label, `FEATURES` and `weight`: at most `train_rows // 2` distinct vectors of each label, those of smallest hash.

    Equal findings are one vector, so copies of rows take no other vector's place. A vector weighs the root of the
    number of its findings, and both labels weigh the same together, so multiplying every row changes nothing.
    """
    names = ["label", *FEATURES]
    distinct = labelled.groupBy(*names).agg(F.count("*").alias("found"))
    half = [
        distinct.filter(F.col("label") == label).orderBy(F.xxhash64(*names), *names).limit(train_rows // 2)
        for label in (0.0, 1.0)]
    taken = written(half[0].unionByName(half[1]).coalesce(1), "op3-sample").coalesce(1)
    # at most train_rows rows; whole millionths, so the sum doesn't depend on their order
    share = F.rint(F.sqrt("found") * 1_000_000).cast("bigint")
    totals = taken.groupBy(F.col("label").alias("_label")).agg(F.sum(share).alias("_total"))
    joined = taken.join(F.broadcast(totals), F.col("label") == F.col("_label"))
    return joined.select(*names, F.round(share / F.col("_total") * (train_rows // 2), 6).alias("weight"))


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Transformer | None:
    """The forest, fitted on the `sample` of findings with `FEATURES` and `label`; None without both labels.

    The sample is read in a fixed order, so the same findings give the same forest.
    """
    taken = sample(labelled, train_rows)
    if taken.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(taken)
    return RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features", weightCol="weight").fit(vectors)


def scored(found: DataFrame, forest: Transformer | None) -> DataFrame:
    """The findings with `score` (probability of a secret) and `secret`. Without a forest the issued formats and named
    values count."""
    if forest is None:
        rule = F.greatest("issued", F.least("named", F.ceil("digits"), 1 - F.col("plain")))
        return found.withColumn("score", rule.cast("double")).withColumn("secret", F.col("score") >= 0.5)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
    voted = forest.transform(vectors).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return voted.drop("features", "rawPrediction", "probability", "prediction").withColumn("secret", F.col("score") >= 0.5)


def scan(docs: DataFrame, at: str, text_col: str, path_col: str | None = None, labelled: DataFrame | None = None) -> DataFrame:
    """All candidates of the located documents: file, row, pos, start, length, candidate, score, secret.

    Without any finding, or with findings of one label only, no forest is fitted and the rule of `scored` decides.
    """
    spark = docs.sparkSession
    words = dictionary(spark, public_tokenizers.path(DICTIONARY))
    found = written(candidates(docs, at, text_col, path_col), "op3-candidates")
    known = written(features(labelled_by_evidence(found) if labelled is None else labelled, words), "op3-labelled")
    forest = train(withheld(known) if labelled is None else known)
    return scored(features(found, words), forest).select(*KEY, "start", "length", "candidate", "score", "secret")


def redact(docs: DataFrame, at: str, text_col: str, found: DataFrame, length_col: str | None = None) -> DataFrame:
    """The documents with every secret replaced by `REDACTED`; `length_col`, if given, gets the new length."""
    spans = found.filter("secret").groupBy("file", "row").agg(
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans"))
    spans = spans.select(F.col("file").alias("_sf"), F.col("row").alias("_sr"), F.col("spans").alias("_spans"))
    text = F.col(text_col)

    def cut(all_: Column) -> Column:
        begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(all_[i - 1].start + all_[i - 1].length)
        kept = F.transform(all_, lambda s, i: F.substring(text, (begin(i) + 1).cast("int"), (s.start - begin(i)).cast("int")))
        last = all_[F.size(all_) - 1]
        tail = F.substring(text, (last.start + last.length + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(kept, REDACTED), F.lit(REDACTED), tail)

    file, row = free_name(docs, "_file"), free_name(docs, "_row")
    here = docs.withColumns({file: F.col(f"{at}.file"), row: F.col(f"{at}.row")})
    joined = here.join(spans, (F.col(file) == F.col("_sf")) & (F.col(row) == F.col("_sr")), "left")
    joined = joined.withColumn(text_col, F.when(F.col("_spans").isNull(), text).otherwise(let(F.col("_spans"), cut)))
    if length_col:
        joined = joined.withColumn(length_col, F.length(text_col).cast("bigint"))
    return joined.select(*docs.columns).drop(at)


def op3(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every candidate of every document with the forest's verdict; the value itself only as its digest."""
    rows, at = located(docs.select("doc_id", "text", "source"), True, "op3")
    ids = docs.select("doc_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    found = scan(rows, at, "text", "source")
    return found.join(ids, ["file", "row"]).select(
        "doc_id", "pos", "start", "length", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "secret")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets replaced."""
    rows, at = located(docs, True, "op3")
    return redact(rows, at, "text", scan(rows, at, "text", "source"), "n_chars")
