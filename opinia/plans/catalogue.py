"""The registered queries: load, call one operator, name the columns.

Lists are shown as one string per document so that results compare by value; nothing is
sampled or cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinia.functions import lists
from opinia.functions import text as X
from opinia.operators import bayes, evaluate, features, insight, lemma, models, sparse, spell, stopwords, terms, tokens
from opinia.plans import select
from opinia.session import materialize
from opinia.sources import reviews

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(column: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    return F.round(column, digits) + F.lit(0.0)


def shown(words: str) -> list[Column]:
    return [
        F.size(words).alias(f"n_{words}"),
        F.array_join(words, "|").alias(words),
    ]


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.load_reviews(spark, sf).select("doc_id", "text")


def doc_words(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, words)`` with the default token pattern."""
    return docs(spark, sf).select("doc_id", X.extract(F.col("text"), X.TOKENS, True).alias("words"))


def labelled_words(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, label, words)`` of the labelled documents."""
    return reviews.labelled_docs(spark, sf).select(
        "doc_id", "label", X.extract(F.col("text"), X.TOKENS, True).alias("words")
    )


def stored_stats(df: DataFrame) -> DataFrame:
    """Term statistics in as many files as there are shuffle partitions: a word becomes dozens of
    keys downstream, so a small table of words is not a small piece of work."""
    stats = terms.term_stats(df)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(stats.repartition(parts, "token"), "words")


# Sources


@query
def preview(spark, sf):
    return reviews.preview(docs(spark, sf), 5)


@query
def corpus_profile(spark, sf):
    labels = reviews.with_label(reviews.read_table(spark, sf, "labels"), "quality")
    return reviews.corpus_profile(reviews.load_reviews(spark, sf), labels.select("doc_id", "label"))


@query
def labelled_docs(spark, sf):
    return reviews.labelled_docs(spark, sf).select("doc_id", "label", "text")


# Tokenizers and token lists


@query
def tokenize_ws(spark, sf):
    return tokens.tokenize_ws(docs(spark, sf)).select("doc_id", *shown("words"))


@query
def token_count(spark, sf):
    return tokens.token_count(tokens.tokenize_ws(docs(spark, sf))).select("doc_id", "tokens")


@query
def tokenize_regex(spark, sf):
    return tokens.tokenize_regex(docs(spark, sf)).select("doc_id", *shown("words"))


@query
def stopwords_default(spark, sf):
    words = tokens.tokenize_ws(docs(spark, sf))
    return stopwords.remove_stop_words(words).select("doc_id", *shown("cleaned"))


@query
def stopwords_custom(spark, sf):
    words = tokens.tokenize_regex(docs(spark, sf))
    cleaned = stopwords.remove_stop_words(words, stop=lists.CUSTOM_STOP_WORDS)
    return cleaned.select("doc_id", *shown("cleaned"))


@query
def bigrams(spark, sf):
    words = tokens.tokenize_regex(docs(spark, sf))
    return terms.ngrams(words).select("doc_id", *shown("bigrams"))


# Annotations


@query
def assemble(spark, sf):
    document = F.col("document")[0]
    return tokens.assemble(docs(spark, sf)).select(
        "doc_id",
        document["result"].alias("result"),
        document["begin"].alias("char_begin"),
        document["end"].alias("char_end"),
    )


@query
def sentences(spark, sf):
    return tokens.sentences(docs(spark, sf))


@query
def sentence_tokens(spark, sf):
    return tokens.sentence_tokens(docs(spark, sf))


@query
def token_table(spark, sf):
    long = tokens.token_table(docs(spark, sf), offsets=True)
    return long.withColumnsRenamed({"begin": "char_begin", "end": "char_end"})


@query
def stopwords_table(spark, sf):
    stop = spark.createDataFrame([(w,) for w in lists.default_stop_words()], "word string")
    return stopwords.remove_stop_table(tokens.token_table(docs(spark, sf)), stop)


@query
def lemmatize(spark, sf):
    stats = stored_stats(doc_words(spark, sf))
    lemmas = materialize(lemma.derive_lemmas(stats), "lemmas")
    return lemma.lemmatize(tokens.token_table(docs(spark, sf)), lemmas, stats)


def found_candidates(stats: DataFrame, max_distance: int = 1) -> DataFrame:
    """Candidates for the suspects among the words, with frequent words as dictionary."""
    dictionary = spell.corpus_dictionary(stats)
    return spell.candidates(spell.suspects(stats, dictionary), dictionary, max_distance)


@query
def spell_candidates(spark, sf):
    return found_candidates(stored_stats(doc_words(spark, sf)))


@query
def spell_candidates_2(spark, sf):
    """Candidates at up to two edits."""
    return found_candidates(stored_stats(doc_words(spark, sf)), max_distance=2)


@query
def spell_correct(spark, sf):
    return spell.best_candidates(found_candidates(stored_stats(doc_words(spark, sf))))


def stored_annotations(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Annotated documents, tokenized once and bucketed by document, and their term statistics."""
    dealt = docs(spark, sf).repartition(select.learner_partitions(spark), "doc_id")
    annotated = materialize(tokens.annotate(dealt).select("doc_id", "tokens"), "annotated", by="doc_id")
    words = annotated.select("doc_id", F.col("tokens.result").alias("words"))
    return annotated, stored_stats(words)


@query
def bigram_lm(spark, sf):
    return spell.bigram_lm(tokens.annotate(docs(spark, sf)))


@query
def spell_context(spark, sf):
    annotated, stats = stored_annotations(spark, sf)
    pairs = materialize(spell.bigram_lm(annotated), "bigrams")
    fixed = spell.correct_in_context(annotated, stats, pairs, materialize(found_candidates(stats), "candidates"))
    return fixed.select("doc_id", "sent", "pos", "token", "corrected")


@query
def finish(spark, sf):
    """Spelling, lemmas, stop words and the finisher in a row."""
    annotated, stats = stored_annotations(spark, sf)
    fixes = materialize(spell.best_candidates(found_candidates(stats)), "corrections")
    changed = spell.compose(stats, fixes, lemma.derive_lemmas(stats))
    cleaned = spell.correct_wide(annotated, changed, "tokens", stats)
    cleaned = stopwords.drop_annotated(cleaned, "tokens", lists.default_stop_words(), lists.NEGATIONS)
    return tokens.finish(cleaned).select(
        "doc_id", F.size("finished").alias("n_finished"), F.array_join("finished", " ").alias("finished")
    )


# Term statistics


@query
def term_counts(spark, sf):
    return terms.term_counts(doc_words(spark, sf))


@query
def term_freq(spark, sf):
    return terms.term_freq(doc_words(spark, sf)).select(
        "doc_id", "token", "tf", rounded("freq", 9).alias("freq")
    )


@query
def doc_freq(spark, sf):
    return terms.term_stats(doc_words(spark, sf)).select("token", "df")


@query
def vocabulary(spark, sf):
    return terms.vocabulary(terms.term_stats(doc_words(spark, sf)))


@query
def top_terms(spark, sf):
    return terms.top_terms(terms.term_stats(doc_words(spark, sf)))


@query
def idf(spark, sf):
    words = doc_words(spark, sf)
    weights = terms.idf(terms.term_stats(words), words.count())
    return weights.select("token", "df", rounded("idf").alias("idf"))


def scored_terms(spark, sf) -> DataFrame:
    words = doc_words(spark, sf)
    weights = terms.idf(stored_stats(words), words.count())
    return terms.tf_idf(terms.term_counts(words), weights)


@query
def tf_idf(spark, sf):
    return scored_terms(spark, sf).select("doc_id", "token", "tf", rounded("tf_idf").alias("tf_idf"))


@query
def top_tf_idf(spark, sf):
    scored = scored_terms(spark, sf).withColumn("tf_idf", rounded("tf_idf"))
    return terms.top_per_document(scored, "tf_idf").select("doc_id", "rank", "token", "tf", "tf_idf")


@query
def hashing_tf(spark, sf):
    words = tokens.tokenize_regex(docs(spark, sf))
    hashed = features.hashing_tf(words, num_features=20)
    buckets = F.posexplode(vector_to_array("rawFeatures")).alias("bucket", "tf")
    return hashed.select("doc_id", buckets).where(F.col("tf") > 0)


@query
def hashing_tf_mass(spark, sf):
    words = tokens.tokenize_regex(docs(spark, sf))
    hashed = features.hashing_tf(words, num_features=20)
    mass = F.aggregate(vector_to_array("rawFeatures"), F.lit(0.0), lambda a, x: a + x)
    return hashed.select("doc_id", mass.alias("mass"))


# Insights


@query
def top_bigrams(spark, sf):
    found = terms.top_ngrams(labelled_words(spark, sf))
    return found.withColumn("pos_share", rounded("pos_share"))


@query
def buzzwords(spark, sf):
    counts = materialize(insight.class_counts(labelled_words(spark, sf)), "class-counts")
    found = insight.buzzwords(counts, k=25, min_count=5)
    return found.withColumnRenamed("class", "label").withColumn("log_odds", rounded("log_odds"))


@query
def term_label_assoc(spark, sf):
    labels = reviews.labelled_docs(spark, sf)
    n_pos, n_neg = models.class_sizes(labels)
    found = insight.term_label_association(insight.class_counts(labelled_words(spark, sf)), n_pos, n_neg)
    return found.select(
        "token", "df", rounded("chi2").alias("chi2"), rounded("pmi").alias("pmi"), "low_count"
    )


def dropped_words() -> dict[str, list[str]]:
    """The stop words of each strategy."""
    return {
        "sw_pre": lists.without(lists.default_stop_words()),
        "sw_cstm": lists.CUSTOM_STOP_WORDS,
        "sw_none": [],
    }


@query
def strategy_stats(spark, sf):
    stats = terms.term_stats(doc_words(spark, sf))
    return insight.strategy_stats(stats, docs(spark, sf).count(), dropped_words())


# Split, naive Bayes and its evaluation


@query
def split_train_test(spark, sf):
    return reviews.labelled_docs(spark, sf).select(
        "doc_id", "label", models.split_column().alias("split")
    )


def nb_predictions(spark, sf) -> DataFrame:
    train, test = models.split_train_test(labelled_words(spark, sf))
    weights, prior = models.nb_train(train)
    return models.nb_score(test, weights, prior)


@query
def score_nb(spark, sf):
    return nb_predictions(spark, sf).select("doc_id", "label", rounded("score").alias("score"), "prediction")


@query
def accuracy(spark, sf):
    found = evaluate.accuracy(nb_predictions(spark, sf))
    return found.select("n", rounded("accuracy").alias("accuracy"), rounded("complement").alias("complement"), "invert")


@query
def confusion(spark, sf):
    return evaluate.confusion(nb_predictions(spark, sf))


@query
def auc(spark, sf):
    return evaluate.auc(nb_predictions(spark, sf)).withColumn("auc", rounded("auc"))


@query
def auc_binned(spark, sf):
    """Bounds of the AUC from 400 bins of the score."""
    counts = evaluate.histogram(nb_predictions(spark, sf), -100.0, 100.0, 400)
    found = evaluate.auc_bounds(counts)
    return found.withColumns({c: rounded(c) for c in ("auc_low", "auc_high")})


def training_words(spark, sf) -> DataFrame:
    return models.split_train_test(labelled_words(spark, sf))[0]


@query
def tune_nb_cv(spark, sf):
    found = select.tune_nb(training_words(spark, sf), how="cv", folds=3)
    return found.withColumn("value", rounded("value"))


@query
def tune_nb_tvs(spark, sf):
    found = select.tune_nb(training_words(spark, sf), how="tvs", train_percent=75)
    return found.withColumn("value", rounded("value"))


@query
def experiment_matrix_nb(spark, sf):
    found = select.experiment_matrix_nb(labelled_words(spark, sf), dropped_words())
    return found.withColumn("value", rounded("value"))


# Spark ML classifiers, at the default width and with the default iterations and trees. The
# label imbalance of the data matters here, not the score: see the tests for learnability.
NUM_FEATURES = 1 << 18


def spread_words(spark, sf) -> DataFrame:
    """The labelled words in the partitions that learners should use, whatever the files' layout."""
    labelled = reviews.labelled_docs(spark, sf).repartition(select.learner_partitions(spark), "doc_id")
    return labelled.select("doc_id", "label", X.extract(F.col("text"), X.TOKENS, True).alias("words"))


def hashed_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """TF-IDF vectors of the two parts, with the IDF of the training part."""
    tf = HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=NUM_FEATURES)
    raw = tf.transform(spread_words(spark, sf)).select("doc_id", "label", "rawFeatures")
    train, test = models.split_train_test(materialize(raw, "hashed"))
    fitted = IDF(inputCol="rawFeatures", outputCol="features").fit(train)
    columns = ["doc_id", "label", "features"]
    return materialize(fitted.transform(train).select(*columns), "vectors"), fitted.transform(test).select(*columns)


def ml_scores(spark, sf, name: str, **params) -> DataFrame:
    train, test = hashed_parts(spark, sf)
    predictions = models.estimator(name, **params).fit(train).transform(test)
    return predictions.select(
        "doc_id", "label", models.score_column(predictions).alias("score"), "prediction"
    )


@query
def score_lr(spark, sf):
    return ml_scores(spark, sf, "lr")


@query
def score_dt(spark, sf):
    return ml_scores(spark, sf, "dt", maxDepth=5)


@query
def score_rf(spark, sf):
    return ml_scores(spark, sf, "rf", maxDepth=5, seed=models.SEED)


@query
def score_svc(spark, sf):
    return ml_scores(spark, sf, "svc")


def stored_parts(spark, sf, *more: Column) -> DataFrame:
    """``(doc_id, label, part, ..., terms)`` of the labelled documents, stored."""
    return bayes.stored_terms(spread_words(spark, sf), [models.split_column().alias("part"), *more])


def hashed_strategies(spark, sf) -> DataFrame:
    """``(strategy, doc_id, part, bucket, tf, tf_idf)``, with the IDF of the training part."""
    parts = stored_parts(spark, sf)
    buckets = sparse.token_buckets(sparse.token_stats(parts), NUM_FEATURES)
    counts = materialize(sparse.hashed_counts(parts, buckets, ["doc_id", "part"], dropped_words()), "hashed-counts")
    n_train = parts.where("part = 'train'").count()
    return sparse.weighted(counts, "part = 'train'", n_train, ["strategy"], "bucket")


@query
def hashed_features(spark, sf):
    """Hashed TF-IDF of the three strategies, in long form."""
    found = hashed_strategies(spark, sf)
    return found.select("strategy", "doc_id", "part", "bucket", "tf", rounded("tf_idf").alias("tf_idf"))


def counted_parts(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored parts, the vocabulary of the training part, and ``(doc_id, index, tf_idf)`` by it."""
    parts = stored_parts(spark, sf)
    vocab = sparse.train_vocabulary(sparse.token_stats(parts, "part = 'train'"), NUM_FEATURES)
    n_train = parts.where("part = 'train'").count()
    counts = sparse.vocabulary_counts(parts, vocab, ["doc_id"])
    entries = counts.withColumn("tf_idf", F.col("tf") * terms.idf_column(F.col("df"), n_train))
    return parts, vocab, entries.select("doc_id", "index", "tf_idf")


@query
def count_vectors(spark, sf):
    """The TF-IDF of both parts by the training part's vocabulary, in long form."""
    return counted_parts(spark, sf)[2].withColumn("tf_idf", rounded("tf_idf"))


@query
def train_vocabulary(spark, sf):
    return counted_parts(spark, sf)[1].select("index", "token", "n", "df")


def fitted_counts(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Count vectors to a fitted logistic regression: coefficients by index, vocabulary, and the
    predictions of the test part."""
    parts, vocab, entries = counted_parts(spark, sf)
    vectors = sparse.stored_vectors(parts.drop("terms"), entries, NUM_FEATURES, "tf_idf", "index")
    model = models.estimator("lr", regParam=0.01).fit(vectors.where("part = 'train'"))
    return select.coefficients(spark, model), vocab, model.transform(vectors.where("part = 'test'"))


@query
def count_vector_accuracy(spark, sf):
    """Vocabulary, counts, IDF, logistic regression and its accuracy on the test part."""
    return evaluate.accuracy(fitted_counts(spark, sf)[2])


@query
def coef_terms(spark, sf):
    weights, vocab, _ = fitted_counts(spark, sf)
    return vocab.select("index", "token").join(weights, "index")


def search(spark, sf, how: str) -> DataFrame:
    train, _ = hashed_parts(spark, sf)
    return select.tune(train, models.estimator("lr"), how=how)[0]


@query
def tune_tvs(spark, sf):
    return search(spark, sf, "tvs")


@query
def tune_cv(spark, sf):
    return search(spark, sf, "cv")


@query
def tune_dt(spark, sf):
    """The decision-tree grid; what an earlier, stopped run finished is not fitted again."""
    train, _ = hashed_parts(spark, sf)
    return select.tune_resumed(train, models.estimator("dt"))


FOLDS = 3


def folded_counts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The training part with its fold, and ``(doc_id, label, fold, bucket, tf)`` of all its tokens."""
    fold = models.hash_bucket("doc_id", models.SEED, FOLDS).cast("int").alias("fold")
    train = bayes.stored_terms(models.split_train_test(spread_words(spark, sf))[0], [fold])
    buckets = sparse.token_buckets(sparse.token_stats(train), NUM_FEATURES)
    counts = sparse.hashed_counts(train, buckets, ["doc_id", "fold"], {"sw_none": []}).drop("strategy")
    return train.drop("terms"), materialize(counts, "folded-counts")


@query
def fold_doc_freq(spark, sf):
    """What each fold's IDF is learned from: the document frequencies of the other folds."""
    return sparse.leave_out_df(folded_counts(spark, sf)[1], FOLDS)


@query
def tune_lr_refit(spark, sf):
    """The logistic-regression grid, with an IDF of its own in every fold."""
    docs, counts = folded_counts(spark, sf)
    vectors = sparse.stored_vectors(docs, counts, NUM_FEATURES, "tf", "bucket")
    df = sparse.leave_out_df(counts, FOLDS)
    return select.tune_refit(vectors, df, models.estimator("lr"), FOLDS, NUM_FEATURES)


@query
def experiment_matrix(spark, sf):
    train, test = models.split_train_test(reviews.labelled_docs(spark, sf))
    return select.experiment_matrix(train, test, num_features=NUM_FEATURES)


def nb_results(spark, sf) -> DataFrame:
    """The naive Bayes metrics as rows of the result store."""
    predictions = materialize(nb_predictions(spark, sf), "predictions")
    found = {
        "accuracy": evaluate.accuracy(predictions).first()["accuracy"],
        "auc_test": evaluate.auc(predictions).first()["auc"],
    }
    return reviews.results_frame(spark, [("sw_none", "nb", "", m, v) for m, v in found.items()])


@query
def results_frame(spark, sf):
    return nb_results(spark, sf).withColumn("value", rounded("value"))


@query
def report(spark, sf):
    return reviews.report_lines(nb_results(spark, sf))
