"""The SQL twins of the registered queries, for an independent engine to run.

They are written from the definitions, not from the Spark plans: tokens come from splitting
at separators, document frequencies from distinct counts, candidates from a delete
neighbourhood checked by edit distance, AUC from mid-ranks, hash buckets from the hash.
"""

from __future__ import annotations

from opinia.functions import lists

SPLIT_SEED = 31415


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w.lower().replace("'", "''") + "'" for w in words)


# Stand for lists that are filled in when a statement is asked for: importing this module reads no file.
STOP_DEFAULT, STOP_KEPT, STOP_CUSTOM = "<stop_default>", "<stop_kept>", "<stop_custom>"


def with_lists(sql: str) -> str:
    """The statement with the words in place of the marks."""
    if STOP_CUSTOM in sql:
        sql = sql.replace(STOP_CUSTOM, quoted(lists.CUSTOM_STOP_WORDS))
    if STOP_DEFAULT in sql or STOP_KEPT in sql:
        default = lists.default_stop_words()
        sql = sql.replace(STOP_DEFAULT, quoted(default)).replace(STOP_KEPT, quoted(lists.without(default)))
    return sql


WS_WORDS = r"""CASE WHEN regexp_matches(lower(text), '^\s+$') THEN []
    ELSE string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s') END"""
REGEX_WORDS = r"""list_filter(string_split_regex(lower(text), '\W'), lambda x: x <> '')"""
TOKEN_WORDS = r"""list_filter(string_split_regex(text, '[^a-zA-Z0-9_'']'), lambda x: x <> '')"""
SENTENCES = r"""list_filter(string_split(
    regexp_replace(text, '([.!?]+)\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')"""

# The constants of the 32-bit MurmurHash3.
MURMUR_C1, MURMUR_C2, MURMUR_ADD = 0xCC9E2D51, 0x1B873593, 0xE6546B64
MURMUR_F1, MURMUR_F2, MURMUR_SEED = 0x85EBCA6B, 0xC2B2AE35, 42
LOW = 0xFFFFFFFF


def rotated(x: str, bits: int) -> str:
    return f"((({x}) << {bits} & {LOW}) | (({x}) >> {32 - bits}))"


def times(x: str, factor: int) -> str:
    return f"(({x}) * {factor}::UBIGINT & {LOW})"


def mixed(k: str) -> str:
    return times(rotated(times(k, MURMUR_C1), 15), MURMUR_C2)


def murmur(word: str) -> str:
    """The signed 32-bit hash of an ASCII word, by the published definition."""
    byte = lambda at: f"CAST(coalesce(ord(nullif(substr({word}, {at}, 1), '')), 0) AS UBIGINT)"
    four = lambda at: " + ".join(f"{byte(f'{at} + {i}')} * {256**i}" for i in range(1, 4))
    block = f"list_transform(range(0, length({word}) // 4), lambda j: {byte('4 * j + 1')} + {four('4 * j + 1')})"
    with_block = f"xor(h, {mixed('k')})"
    step = f"(({rotated(with_block, 13)}) * 5 + {MURMUR_ADD}) & {LOW}"
    body = f"list_reduce(list_prepend({MURMUR_SEED}::UBIGINT, {block}), lambda h, k: {step})"
    rest = f"4 * (length({word}) // 4) + 1"
    tail = mixed(f"{byte(rest)} + {four(rest)}")
    shifted = lambda h, bits: f"xor({h}, ({h}) >> {bits})"
    return (
        f"(SELECT CASE WHEN h >= 2147483648 THEN CAST(h AS BIGINT) - 4294967296 ELSE CAST(h AS BIGINT) END "
        f"FROM (SELECT {shifted('h', 16)} AS h FROM (SELECT {times(shifted('h', 13), MURMUR_F2)} AS h "
        f"FROM (SELECT {times(shifted('h', 16), MURMUR_F1)} AS h "
        f"FROM (SELECT xor(xor({body}, {tail}), length({word})::UBIGINT) AS h)))))"
    )


# Common table expressions, by name, with what they stand on.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "labelled": (
        (),
        """SELECT d.doc_id, d.text, CAST(l.quality AS DOUBLE) AS label
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL""",
    ),
    "sents": (
        (),
        f"""SELECT doc_id, generate_subscripts(l, 1) - 1 AS sent, unnest(l) AS sentence
        FROM (SELECT doc_id, {SENTENCES} AS l FROM documents)""",
    ),
    "toks": (
        ("sents",),
        r"""SELECT doc_id, CAST(sent AS INTEGER) AS sent,
            CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, lower(unnest(l)) AS token
        FROM (SELECT doc_id, sent, list_filter(
            string_split_regex(sentence, '[^a-zA-Z0-9_'']'), lambda x: x <> '') AS l FROM sents)""",
    ),
    "words": (
        (),
        f"""SELECT doc_id, lower(unnest({TOKEN_WORDS})) AS token FROM documents""",
    ),
    "lwords": (
        ("labelled",),
        f"""SELECT doc_id, label, lower(unnest({TOKEN_WORDS})) AS token FROM labelled""",
    ),
    "tf": (("words",), "SELECT doc_id, token, count(*) AS tf FROM words GROUP BY ALL"),
    "stats": (
        ("words",),
        "SELECT token, count(DISTINCT doc_id) AS df, count(*) AS n FROM words GROUP BY token",
    ),
    "idfs": (
        ("stats",),
        """SELECT token, df, ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1)) AS idf
        FROM stats""",
    ),
    "tfidf": (
        ("tf", "idfs"),
        """SELECT doc_id, token, CAST(tf AS INTEGER) AS tf, round(tf * idf, 6) + 0.0 AS tf_idf
        FROM tf JOIN idfs USING (token)""",
    ),
    "dict": (
        ("stats",),
        "SELECT token AS word, n AS freq FROM stats WHERE n >= 5 AND length(token) >= 3",
    ),
    "odd": (
        ("stats", "dict"),
        """SELECT token FROM stats WHERE length(token) >= 4
        AND NOT regexp_matches(token, '[0-9]') AND token NOT IN (SELECT word FROM dict)""",
    ),
    "oddkeys": (
        ("odd",),
        """SELECT token, token AS k FROM odd UNION SELECT token, unnest(list_transform(
            range(1, length(token) + 1),
            lambda i: substr(token, 1, i - 1) || substr(token, i + 1))) FROM odd""",
    ),
    "dictkeys": (
        ("dict",),
        """SELECT word, freq, word AS k FROM dict UNION SELECT word, freq, unnest(list_transform(
            range(1, length(word) + 1),
            lambda i: substr(word, 1, i - 1) || substr(word, i + 1))) FROM dict""",
    ),
    "cands": (
        ("oddkeys", "dictkeys"),
        """SELECT DISTINCT token, word AS candidate, freq FROM oddkeys JOIN dictkeys USING (k)
        WHERE levenshtein(token, word) <= 1
            OR (length(token) = length(word) AND damerau_levenshtein(token, word) = 1)""",
    ),
    "fixes": (
        ("cands",),
        """SELECT token, candidate AS corrected, freq FROM cands
        QUALIFY row_number() OVER (PARTITION BY token ORDER BY freq DESC, candidate) = 1""",
    ),
    "lemmas": (
        ("stats",),
        """SELECT form, min(stem) AS lemma FROM (
            SELECT token AS form, CASE WHEN suffix(token, e) AND length(token) - length(e) >= 3
                THEN left(token, length(token) - length(e)) END AS stem
            FROM stats, (VALUES ('ing'), ('ed'), ('tion'), ('s')) AS v(e))
        WHERE stem IN (SELECT token FROM stats) GROUP BY form""",
    ),
    "ctx": (
        ("toks",),
        """SELECT doc_id, sent, pos, token,
            lag(token) OVER (PARTITION BY doc_id, sent ORDER BY pos) AS prev,
            lead(token) OVER (PARTITION BY doc_id, sent ORDER BY pos) AS next FROM toks""",
    ),
    "pairs": (
        ("ctx",),
        "SELECT prev, token, count(*) AS n FROM ctx WHERE prev IS NOT NULL GROUP BY ALL",
    ),
    "parts": (
        ("labelled",),
        f"""SELECT doc_id, label, text, CASE WHEN CAST('0x' || substr(md5('{SPLIT_SEED}|' || doc_id), 1, 8)
            AS UBIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM labelled""",
    ),
    "ptf": (
        ("parts",),
        f"""SELECT doc_id, label, split, token, count(*) AS tf FROM (
            SELECT doc_id, label, split, lower(unnest({TOKEN_WORDS})) AS token FROM parts)
        GROUP BY ALL""",
    ),
    "model": (
        ("ptf",),
        """SELECT token, ln((p + 1.0) / (sum(p) OVER () + count(*) OVER ()))
            - ln((q + 1.0) / (sum(q) OVER () + count(*) OVER ())) AS weight
        FROM (SELECT token, coalesce(sum(tf) FILTER (label = 1), 0) AS p,
            coalesce(sum(tf) FILTER (label = 0), 0) AS q
            FROM ptf WHERE split = 'train' GROUP BY token)""",
    ),
    "preds": (
        ("parts", "ptf", "model"),
        """SELECT doc_id, label, score, CASE WHEN score > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
        FROM (SELECT p.doc_id, p.label, round((SELECT ln(count(*) FILTER (label = 1)
                / CAST(count(*) FILTER (label = 0) AS DOUBLE)) FROM parts WHERE split = 'train')
                + coalesce(e.evidence, 0.0), 6) + 0.0 AS score
            FROM parts p LEFT JOIN (SELECT doc_id, sum(tf * weight) AS evidence
                FROM ptf JOIN model USING (token) WHERE split = 'test' GROUP BY doc_id) e
            ON p.doc_id = e.doc_id WHERE p.split = 'test')""",
    ),
}

BODIES: dict[str, str] = {
    "preview": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 5",
    "corpus_profile": """SELECT CAST(l.quality AS DOUBLE) AS label, count(*) AS n_docs,
        count(*) FILTER (d.text IS NULL) AS n_null_text, count(*) FILTER (d.text = '') AS n_empty_text,
        CAST(sum(length(coalesce(d.text, ''))) AS BIGINT) AS n_chars
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
    "labelled_docs": "SELECT doc_id, label, text FROM labelled",
    "tokenize_ws": f"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, '|') AS words
        FROM (SELECT doc_id, {WS_WORDS} AS w FROM documents)""",
    "token_count": f"""SELECT doc_id, CAST(len({WS_WORDS}) AS INTEGER) AS tokens FROM documents""",
    "tokenize_regex": f"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, '|') AS words
        FROM (SELECT doc_id, {REGEX_WORDS} AS w FROM documents)""",
    "stopwords_default": f"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_cleaned, array_to_string(w, '|') AS cleaned
        FROM (SELECT doc_id, list_filter({WS_WORDS}, lambda x: x NOT IN ({STOP_DEFAULT})) AS w FROM documents)""",
    "stopwords_custom": f"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_cleaned, array_to_string(w, '|') AS cleaned
        FROM (SELECT doc_id, list_filter({REGEX_WORDS}, lambda x: x NOT IN ({STOP_CUSTOM})) AS w FROM documents)""",
    "bigrams": f"""SELECT doc_id, CAST(len(b) AS INTEGER) AS n_bigrams, array_to_string(b, '|') AS bigrams
        FROM (SELECT doc_id, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]) AS b
        FROM (SELECT doc_id, {REGEX_WORDS} AS w FROM documents))""",
    "assemble": r"""SELECT doc_id, result, 0 AS char_begin, CAST(length(result) - 1 AS INTEGER) AS char_end
        FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') AS result FROM documents)""",
    "sentences": "SELECT doc_id, CAST(sent AS INTEGER) AS sent, sentence FROM sents",
    "sentence_tokens": r"""SELECT doc_id, CAST(sent AS INTEGER) AS sent,
        CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS token
        FROM (SELECT doc_id, sent, regexp_extract_all(sentence,
            '[\p{L}\p{N}_]+(?:[''\-][\p{L}\p{N}_]+)*|[^\s\p{L}\p{N}_]+') AS l FROM sents)""",
    "token_table": r"""SELECT t.doc_id, t.sent, t.pos, t.token, CAST(b.char_begin AS INTEGER) AS char_begin,
            CAST(b.char_begin + length(t.token) - 1 AS INTEGER) AS char_end
        FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sent, pos) AS k FROM toks) t
        JOIN (SELECT doc_id, char_begin, row_number() OVER (PARTITION BY doc_id ORDER BY char_begin) AS k
            FROM (SELECT doc_id, piece, coalesce(sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY p
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS char_begin
                FROM (SELECT doc_id, unnest(l) AS piece, generate_subscripts(l, 1) AS p
                    FROM (SELECT doc_id, string_split_regex(text, '[^a-zA-Z0-9_'']') AS l FROM documents)))
            WHERE piece <> '') b ON t.doc_id = b.doc_id AND t.k = b.k""",
    "stopwords_table": f"SELECT doc_id, sent, pos, token FROM toks WHERE token NOT IN ({STOP_KEPT})",
    "lemmatize": """SELECT doc_id, sent, pos, token, coalesce(lemma, token) AS lemma
        FROM toks LEFT JOIN lemmas ON token = form""",
    "spell_candidates": "SELECT token, candidate, 1 AS distance, freq FROM cands",
    "spell_correct": "SELECT token, corrected, 1 AS distance, freq FROM fixes",
    "bigram_lm": "SELECT prev, token, n FROM pairs",
    "spell_context": """SELECT doc_id, sent, pos, token, candidate AS corrected FROM (
        SELECT c.doc_id, c.sent, c.pos, c.token, k.candidate, k.freq, round(
            CASE WHEN c.prev IS NULL THEN 0.0 ELSE ln(coalesce(a.n, 0) + 1.0) END
            + CASE WHEN c.next IS NULL THEN 0.0 ELSE
                ln((coalesce(b.n, 0) + 1.0) / (k.freq + (SELECT CAST(count(*) AS DOUBLE) FROM stats))) END
            - 1.0, 9) AS score
        FROM ctx c JOIN cands k ON c.token = k.token
        LEFT JOIN pairs a ON a.prev = c.prev AND a.token = k.candidate
        LEFT JOIN pairs b ON b.prev = k.candidate AND b.token = c.next)
        QUALIFY row_number() OVER (PARTITION BY doc_id, sent, pos
            ORDER BY score DESC, freq DESC, candidate) = 1""",
    "finish": f"""SELECT d.doc_id, CAST(coalesce(f.n, 0) AS INTEGER) AS n_finished,
            coalesce(f.finished, '') AS finished
        FROM documents d LEFT JOIN (
            SELECT doc_id, count(*) AS n, string_agg(final, ' ' ORDER BY sent, pos) AS finished FROM (
                SELECT doc_id, sent, pos, coalesce(lemma, spelled) AS final FROM (
                    SELECT doc_id, sent, pos, coalesce(corrected, token) AS spelled
                    FROM toks LEFT JOIN fixes USING (token)) LEFT JOIN lemmas ON spelled = form)
            WHERE final NOT IN ({STOP_KEPT}) GROUP BY doc_id) f ON d.doc_id = f.doc_id""",
    "term_counts": "SELECT doc_id, token, CAST(tf AS INTEGER) AS tf FROM tf",
    "term_freq": """SELECT doc_id, token, CAST(tf AS INTEGER) AS tf,
        round(tf / CAST(sum(tf) OVER (PARTITION BY doc_id) AS DOUBLE), 9) + 0.0 AS freq FROM tf""",
    "doc_freq": "SELECT token, df FROM stats",
    "vocabulary": """SELECT CAST(row_number() OVER (ORDER BY n DESC, token) - 1 AS BIGINT) AS index, token, n, df
        FROM stats""",
    "top_terms": "SELECT token, n, df FROM stats ORDER BY n DESC, token LIMIT 50",
    "idf": "SELECT token, df, round(idf, 6) + 0.0 AS idf FROM idfs",
    "tf_idf": "SELECT doc_id, token, tf, tf_idf FROM tfidf",
    "top_tf_idf": """SELECT doc_id, CAST(rank AS INTEGER) AS rank, token, tf, tf_idf FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tf_idf DESC, token) AS rank FROM tfidf)
        WHERE rank <= 5""",
    "hashing_tf": f"""SELECT doc_id, CAST((bucket + 20) % 20 AS INTEGER) AS bucket, CAST(sum(n) AS DOUBLE) AS tf
        FROM (SELECT doc_id, token, count(*) AS n FROM (
            SELECT doc_id, unnest({REGEX_WORDS}) AS token FROM documents) GROUP BY ALL)
        JOIN (SELECT token, {murmur('token')} % 20 AS bucket FROM (
            SELECT DISTINCT unnest({REGEX_WORDS}) AS token FROM documents)) USING (token)
        GROUP BY ALL""",
    "hashing_tf_mass": f"SELECT doc_id, CAST(len({REGEX_WORDS}) AS DOUBLE) AS mass FROM documents",
    "top_bigrams": f"""SELECT ngram, count(*) AS n, count(*) FILTER (label = 1) AS n_pos,
            count(*) FILTER (label = 0) AS n_neg,
            round(count(*) FILTER (label = 1) / CAST(count(*) AS DOUBLE), 6) + 0.0 AS pos_share
        FROM (SELECT label, unnest(list_transform(range(1, greatest(len(w), 1)),
                lambda i: lower(w[i] || ' ' || w[i + 1]))) AS ngram
            FROM (SELECT label, {TOKEN_WORDS} AS w FROM labelled))
        GROUP BY ngram ORDER BY n DESC, ngram LIMIT 50""",
    "buzzwords": """SELECT CAST(label AS INTEGER) AS label, CAST(rank AS INTEGER) AS rank, token,
            CAST(p AS BIGINT) AS n_pos, CAST(q AS BIGINT) AS n_neg, round(o, 6) + 0.0 AS log_odds
        FROM (SELECT c.label, t.*, row_number() OVER (PARTITION BY c.label
                ORDER BY CASE WHEN c.label = 1 THEN -o ELSE o END, token) AS rank
            FROM (VALUES (1), (0)) AS c(label), (
                SELECT token, p, q, round(ln((p + 1.0) / sp) - ln((q + 1.0) / sq), 9) AS o FROM (
                    SELECT token, p, q, sum(p) OVER () + count(*) OVER () AS sp,
                        sum(q) OVER () + count(*) OVER () AS sq
                    FROM (SELECT token, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q
                        FROM lwords GROUP BY token))
                WHERE p + q >= 5) t)
        WHERE rank <= 25""",
    "term_label_assoc": """SELECT token, df, round(n * (a * d - b * c) * (a * d - b * c)
                / ((a + b) * (c + d) * np * nn), 6) + 0.0 AS chi2,
            round(CASE WHEN a > 0 THEN ln(a * n / ((a + b) * np)) END, 6) + 0.0 AS pmi, df < 5 AS low_count
        FROM (SELECT token, df, n, np, nn, a, b, np - a AS c, nn - b AS d FROM (
            SELECT token, count(DISTINCT doc_id) AS df,
                CAST(count(DISTINCT doc_id) FILTER (label = 1) AS DOUBLE) AS a,
                CAST(count(DISTINCT doc_id) FILTER (label = 0) AS DOUBLE) AS b
            FROM lwords GROUP BY token) t,
            (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (label = 1) AS DOUBLE) AS np,
                CAST(count(*) FILTER (label = 0) AS DOUBLE) AS nn FROM labelled) s)""",
    "strategy_stats": f"""SELECT strategy, (SELECT count(*) FROM documents) AS n_docs,
            count(*) AS n_tokens, count(DISTINCT token) AS n_terms
        FROM (SELECT 'sw_none' AS strategy, token FROM words
            UNION ALL SELECT 'sw_pre', token FROM words WHERE token NOT IN ({STOP_KEPT})
            UNION ALL SELECT 'sw_cstm', token FROM words WHERE token NOT IN ({STOP_CUSTOM}))
        GROUP BY strategy""",
    "split_train_test": "SELECT doc_id, label, split FROM parts",
    "score_nb": "SELECT doc_id, label, score, prediction FROM preds",
    "accuracy": """SELECT count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS accuracy,
            round(1 - avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS complement,
            avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) < 0.5 AS invert
        FROM preds""",
    "confusion": "SELECT label, prediction, count(*) AS n FROM preds GROUP BY ALL",
    "auc": """SELECT CAST(np AS BIGINT) AS n_pos, CAST(nn AS BIGINT) AS n_neg,
            round((ranks - np * (np + 1) / 2.0) / (CAST(np AS DOUBLE) * nn), 6) + 0.0 AS auc
        FROM (SELECT count(*) FILTER (label = 1) AS np, count(*) FILTER (label = 0) AS nn,
            sum(mid) FILTER (label = 1) AS ranks
            FROM (SELECT label, rank() OVER (ORDER BY score)
                + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mid FROM preds))""",
}
HASHED_ID = f"CAST('0x' || substr(md5('{SPLIT_SEED}|' || doc_id), 1, 8) AS UBIGINT)"


def metrics_of(scores: str, by: str) -> str:
    """AUC and accuracy of the groups ``by`` of a table (label, score, prediction)."""
    ranks = f"""SELECT {by}, label, rank() OVER (PARTITION BY {by} ORDER BY score)
        + (count(*) OVER (PARTITION BY {by}, score) - 1) / 2.0 AS mid FROM {scores}"""
    return f"""SELECT {by}, 'auc' AS metric, CASE WHEN np > 0 AND nn > 0
            THEN (ranks - np * (np + 1) / 2.0) / (CAST(np AS DOUBLE) * nn) END AS value
        FROM (SELECT {by}, count(*) FILTER (label = 1) AS np, count(*) FILTER (label = 0) AS nn,
            sum(mid) FILTER (label = 1) AS ranks FROM ({ranks}) GROUP BY {by})
        UNION ALL SELECT {by}, 'accuracy', avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)
        FROM {scores} GROUP BY {by}"""


def nb_search(fold: str, held_out: str) -> str:
    """Every fold's model is counted from the documents of the other folds."""
    return f"""WITH f AS (SELECT *, CAST({fold} AS INTEGER) AS fold FROM parts WHERE split = 'train'),
        t AS (SELECT p.doc_id, p.label, p.token, p.tf, f.fold FROM ptf p JOIN f USING (doc_id)),
        h AS (SELECT unnest({held_out}) AS fold),
        m AS (SELECT h.fold, token, coalesce(sum(tf) FILTER (label = 1), 0) AS p,
            coalesce(sum(tf) FILTER (label = 0), 0) AS q FROM t JOIN h ON t.fold <> h.fold GROUP BY ALL),
        z AS (SELECT fold, sum(p) AS sp, sum(q) AS sq, count(*) AS v FROM m GROUP BY fold),
        pr AS (SELECT h.fold, ln(count(*) FILTER (label = 1) / CAST(count(*) FILTER (label = 0) AS DOUBLE)) AS prior
            FROM f JOIN h ON f.fold <> h.fold GROUP BY h.fold),
        s AS (SELECT CAST(unnest([0.1, 0.5, 1.0, 2.0]) AS DOUBLE) AS smoothing),
        e AS (SELECT t.doc_id, smoothing, sum(tf * (ln((p + smoothing) / (sp + smoothing * v))
                - ln((q + smoothing) / (sq + smoothing * v)))) AS evidence
            FROM t JOIN m ON t.token = m.token AND t.fold = m.fold JOIN z ON t.fold = z.fold, s GROUP BY ALL),
        c AS (SELECT f.doc_id, f.label, f.fold, s.smoothing, round(prior + coalesce(evidence, 0.0), 6) AS score
            FROM f JOIN pr ON f.fold = pr.fold CROSS JOIN s
            LEFT JOIN e ON f.doc_id = e.doc_id AND s.smoothing = e.smoothing),
        d AS (SELECT *, CASE WHEN score > 0 THEN 1.0 ELSE 0.0 END AS prediction FROM c),
        x AS ({metrics_of('d', 'smoothing, fold')}),
        y AS (SELECT smoothing, metric, avg(value) AS value FROM x GROUP BY ALL),
        b AS (SELECT smoothing FROM y WHERE metric = 'auc' AND value IS NOT NULL ORDER BY round(value, 9) DESC, smoothing LIMIT 1)
        SELECT 'smoothing=' || smoothing AS params, fold, metric, round(value, 6) + 0.0 AS value,
            coalesce(smoothing = (SELECT smoothing FROM b), false) AS is_best
        FROM (SELECT smoothing, CAST(fold AS VARCHAR) AS fold, metric, value FROM x
            UNION ALL SELECT smoothing, 'mean', metric, value FROM y)"""


BODIES["tune_nb_cv"] = nb_search(f"{HASHED_ID} % 3", "[0, 1, 2]")
BODIES["tune_nb_tvs"] = nb_search(f"CASE WHEN {HASHED_ID} % 100 >= 75 THEN 1 ELSE 0 END", "[1]")
BODIES["experiment_matrix_nb"] = f"""WITH k AS (
        SELECT 'sw_none' AS strategy, * FROM ptf
        UNION ALL SELECT 'sw_pre', * FROM ptf WHERE token NOT IN ({STOP_KEPT})
        UNION ALL SELECT 'sw_cstm', * FROM ptf WHERE token NOT IN ({STOP_CUSTOM})),
    m AS (SELECT strategy, token, coalesce(sum(tf) FILTER (label = 1), 0) AS p,
        coalesce(sum(tf) FILTER (label = 0), 0) AS q FROM k WHERE split = 'train' GROUP BY ALL),
    w AS (SELECT strategy, token, ln((p + 1.0) / (sum(p) OVER (PARTITION BY strategy) + count(*) OVER (PARTITION BY strategy)))
        - ln((q + 1.0) / (sum(q) OVER (PARTITION BY strategy) + count(*) OVER (PARTITION BY strategy))) AS weight FROM m),
    e AS (SELECT strategy, doc_id, sum(tf * weight) AS evidence FROM k JOIN w USING (strategy, token) GROUP BY ALL),
    d AS (SELECT s.strategy, p.doc_id, p.label, p.split AS part, round((SELECT ln(count(*) FILTER (label = 1)
            / CAST(count(*) FILTER (label = 0) AS DOUBLE)) FROM parts WHERE split = 'train') + coalesce(evidence, 0.0), 6) AS score
        FROM parts p CROSS JOIN (SELECT unnest(['sw_pre', 'sw_cstm', 'sw_none']) AS strategy) s
        LEFT JOIN e ON p.doc_id = e.doc_id AND s.strategy = e.strategy),
    g AS (SELECT *, CASE WHEN score > 0 THEN 1.0 ELSE 0.0 END AS prediction FROM d)
    SELECT strategy AS pipeline, 'nb' AS model, '' AS params, metric || '_' || part AS metric,
        round(value, 6) + 0.0 AS value FROM ({metrics_of('g', 'strategy, part')})"""
BODIES["auc_binned"] = """WITH h AS (
        SELECT least(greatest(floor((score + 100.0) / 0.5), 0), 399) AS bin, count(*) FILTER (label = 1) AS p,
            count(*) FILTER (label = 0) AS n FROM preds GROUP BY 1),
    s AS (SELECT sum(p) AS np, sum(n) AS nn FROM h)
    SELECT CAST(np AS BIGINT) AS n_pos, CAST(nn AS BIGINT) AS n_neg,
        round(sure / (CAST(np AS DOUBLE) * nn), 6) + 0.0 AS auc_low,
        round((sure + open_) / (CAST(np AS DOUBLE) * nn), 6) + 0.0 AS auc_high
    FROM s, (SELECT CAST(sum(a.p * b.n) FILTER (b.bin < a.bin) AS DOUBLE) AS sure,
            CAST(sum(a.p * b.n) FILTER (b.bin = a.bin) AS DOUBLE) AS open_ FROM h a, h b)"""
CTES["buckets"] = (
    ("ptf",),
    f"""SELECT token, CAST((h % 262144 + 262144) % 262144 AS INTEGER) AS bucket
        FROM (SELECT token, {murmur('token')} AS h FROM (SELECT DISTINCT token FROM ptf))""",
)
BODIES["hashed_features"] = f"""WITH k AS (
        SELECT 'sw_none' AS strategy, * FROM ptf
        UNION ALL SELECT 'sw_pre', * FROM ptf WHERE token NOT IN ({STOP_KEPT})
        UNION ALL SELECT 'sw_cstm', * FROM ptf WHERE token NOT IN ({STOP_CUSTOM})),
    c AS (SELECT strategy, doc_id, split AS part, bucket, CAST(sum(tf) AS BIGINT) AS tf
        FROM k JOIN buckets USING (token) GROUP BY ALL),
    v AS (SELECT strategy, bucket, count(*) AS df FROM c WHERE part = 'train' GROUP BY ALL)
    SELECT c.strategy, doc_id, part, c.bucket, tf, round(tf * ln(((SELECT count(*) FROM parts WHERE split = 'train') + 1.0)
        / (coalesce(df, 0) + 1)), 6) + 0.0 AS tf_idf
    FROM c LEFT JOIN v ON c.strategy = v.strategy AND c.bucket = v.bucket"""
TRAIN_VOCABULARY = """SELECT CAST(row_number() OVER (ORDER BY n DESC, token) - 1 AS BIGINT) AS index, token, n, df
    FROM (SELECT token, CAST(sum(tf) AS BIGINT) AS n, count(*) AS df FROM ptf WHERE split = 'train' GROUP BY token)"""
BODIES["train_vocabulary"] = f"""WITH v AS (FROM ptf) {TRAIN_VOCABULARY} QUALIFY index < 262144"""
BODIES["count_vectors"] = f"""WITH v AS ({TRAIN_VOCABULARY})
    SELECT doc_id, index, round(tf * ln(((SELECT count(*) FROM parts WHERE split = 'train') + 1.0) / (df + 1)), 6) + 0.0 AS tf_idf
    FROM ptf JOIN v USING (token) WHERE index < 262144"""
BODIES["fold_doc_freq"] = f"""WITH c AS (SELECT DISTINCT doc_id, CAST({HASHED_ID} % 3 AS INTEGER) AS own, bucket
        FROM ptf JOIN buckets USING (token) WHERE split = 'train')
    SELECT fold, bucket, count(*) AS df FROM c, (SELECT unnest([0, 1, 2]) AS fold) WHERE own <> fold GROUP BY ALL"""
BODIES["spell_candidates_2"] = """WITH o1 AS (SELECT token, token AS k FROM odd WHERE length(token) <= (SELECT max(length(word)) + 2 FROM dict)),
    o2 AS (FROM o1 UNION SELECT token, unnest(list_transform(range(1, length(k) + 1), lambda i: substr(k, 1, i - 1) || substr(k, i + 1))) FROM o1),
    o3 AS (FROM o2 UNION SELECT token, unnest(list_transform(range(1, length(k) + 1), lambda i: substr(k, 1, i - 1) || substr(k, i + 1))) FROM o2),
    w2 AS (SELECT word, freq, word AS k FROM dict UNION SELECT word, freq, unnest(list_transform(
        range(1, length(word) + 1), lambda i: substr(word, 1, i - 1) || substr(word, i + 1))) FROM dict),
    w3 AS (FROM w2 UNION SELECT word, freq, unnest(list_transform(
        range(1, length(k) + 1), lambda i: substr(k, 1, i - 1) || substr(k, i + 1))) FROM w2),
    p AS (SELECT DISTINCT token, word AS candidate, freq FROM o3 JOIN w3 USING (k))
    SELECT token, candidate, freq, CAST(CASE WHEN length(token) = length(candidate)
        AND damerau_levenshtein(token, candidate) = 1 THEN 1 ELSE levenshtein(token, candidate) END AS INTEGER) AS distance
    FROM p WHERE levenshtein(token, candidate) <= 2"""
NB_METRICS = f"""SELECT 'accuracy' AS metric, accuracy AS value FROM ({BODIES['accuracy']})
    UNION ALL SELECT 'auc_test', auc FROM ({BODIES['auc']})"""
BODIES["results_frame"] = f"""SELECT 'sw_none' AS pipeline, 'nb' AS model, '' AS params, metric, value
    FROM ({NB_METRICS})"""
BODIES["report"] = f"""SELECT printf('sw_none - nb: %s=%.6f', metric, value) AS line FROM ({NB_METRICS})"""


def statement(name: str) -> str:
    """The body with the common table expressions it reaches, in order of dependence."""
    body = BODIES[name]
    needed: list[str] = []

    def need(cte: str) -> None:
        for base in CTES[cte][0]:
            need(base)
        if cte not in needed:
            needed.append(cte)

    words = set(body.replace("(", " ").replace(")", " ").replace(",", " ").split())
    for cte in CTES:
        if cte in words:
            need(cte)
    if not needed:
        return body
    # A body's own tables come after those it stands on.
    if body.startswith("WITH "):
        body = f"SELECT * FROM ({body})"
    return "WITH " + ",\n".join(f"{c} AS ({CTES[c][1]})" for c in needed) + "\n" + body


def statements() -> dict[str, str]:
    return {name: with_lists(statement(name)) for name in BODIES}
