"""SQL fragments shared by the twins."""

from __future__ import annotations

from collections.abc import Sequence

from textmark import settings
from textmark.functions.keys import share_limit
from textmark.plans.learners import BALANCE_SALT
from textmark.sources.tables import LANGUAGE_MARKS
from textmark.sources.words import SAMPLE_LEMMAS, SAMPLE_STOP_WORDS

TRAIN_LIMIT = share_limit(settings.TRAIN_SHARE)

# RE2 has no look-around: take whole words, then keep those of letters only.
RAW_TOKENS = (
    r"list_filter(regexp_extract_all(text, '(?:[\p{L}\p{Nd}]\p{Mn}*|_)+'), "
    r"lambda x: regexp_full_match(x, '\p{L}+'))"
)

LANGUAGE_RATED = (
    "SELECT doc_id, CASE lang "
    + " ".join(f"WHEN '{name}' THEN {mark}.0" for mark, name in enumerate(LANGUAGE_MARKS, 1))
    + " END::DOUBLE AS rating, text FROM documents"
)
QUALITY_RATED = (
    "SELECT d.doc_id, l.quality::DOUBLE AS rating, d.text "
    "FROM documents d JOIN labels l ON l.doc_id = d.doc_id"
)
EVENT_RESULTS = (
    "SELECT event_id, user_id, event_type AS member, "
    "(1 + CAST(floor(value) AS BIGINT) % 10)::DOUBLE AS prediction, "
    "(1 + event_id % 10)::DOUBLE AS label FROM events"
)

STOP = "stop(word) AS (VALUES " + ", ".join(f"('{w}')" for w in SAMPLE_STOP_WORDS) + ")"
LEMMA = (
    "lemma(token, rnk, stem) AS (VALUES "
    + ", ".join(f"('{t}', {r}, '{s}')" for t, r, s in SAMPLE_LEMMAS)
    + ")"
)


def token_rows(source: str = "documents", key: str = "doc_id") -> str:
    """``raw`` and ``tokens`` as common table expressions."""
    return f"""
    raw AS (SELECT {key}, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS token
            FROM (SELECT {key}, {RAW_TOKENS} AS w FROM {source})),
    tokens AS (SELECT {key}, pos, lower(token) AS token FROM raw)"""


def word_rows(source: str = "documents", key: str = "doc_id") -> str:
    """Prepared words: stems of the tokens that are not on the stop list."""
    return f"""{token_rows(source, key)},
    {STOP}, {LEMMA},
    words AS (SELECT t.{key}, t.pos, coalesce(l.stem, t.token) AS word
              FROM tokens t LEFT JOIN lemma l ON l.token = t.token AND l.rnk = 1
              WHERE coalesce(l.stem, t.token) NOT IN (SELECT word FROM stop))"""


def bayes(
    rated: str,
    members: Sequence[tuple[str, str]],
    target: float | None = None,
    holdout: bool = True,
    scope: str = "train",
    unlabelled: bool = False,
    places: int = 0,
) -> str:
    """Naive Bayes by the formula; ``unlabelled`` texts are scored, never fitted on.

    With ``places`` the features are hashed counts by that many places, weighted by the
    IDF of the fitted texts, in place of terms.

    Ends in ``scores(member, doc_id, label, score, place)`` for every rated text,
    ``marks(member, doc_id, mark)`` with the best label, and ``labelled`` with
    each member's rows and sides.
    """
    smooth = f"{settings.BAYES_SMOOTHING}::DOUBLE"
    names = ", ".join(f"('{name}', '{salt}')" for name, salt in members)
    in_train = f"substring(md5(m.salt || r.doc_id::VARCHAR), 1, 8) < '{TRAIN_LIMIT}'"
    vocabulary_rows = (
        "WHERE doc_id IN (SELECT doc_id FROM sides WHERE in_train)"
        if holdout and scope == "train"
        else ""
    )
    if target is None:
        labelled = "SELECT member, doc_id, rating AS label, in_train FROM sides"
    else:
        labelled = f"""
        SELECT member, doc_id, label, in_train FROM (
            SELECT *, min(n_label) OVER (PARTITION BY member) AS n_min FROM (
                SELECT s.member, s.doc_id, s.in_train, (s.rating = {target})::DOUBLE AS label,
                       row_number() OVER (PARTITION BY s.member, s.rating = {target}
                           ORDER BY md5(m.salt || '{BALANCE_SALT}' || s.doc_id::VARCHAR), s.doc_id) AS place,
                       count(*) OVER (PARTITION BY s.member, s.rating = {target}) AS n_label
                FROM sides s JOIN members m ON m.member = s.member))
        WHERE place <= n_min"""
    fitted = "WHERE in_train" if holdout else ""
    counts = """counts AS (SELECT doc_id, word, count(*)::DOUBLE AS n
               FROM words JOIN vocabulary USING (word) GROUP BY doc_id, word)"""
    width = "(SELECT count(*) FROM vocabulary)"
    if places:
        width = str(places)
        counts = f"""{hashed_places("SELECT DISTINCT word AS term FROM words", places)},
    hashed AS (SELECT doc_id, bucket AS word, count(*)::DOUBLE AS n
               FROM words w JOIN murmur m ON m.term = w.word GROUP BY doc_id, bucket),
    known AS (SELECT doc_id FROM rated {vocabulary_rows}),
    spread AS (SELECT word, count(*) AS df FROM hashed JOIN known USING (doc_id) GROUP BY word),
    counts AS (SELECT h.doc_id, word, n * ln(((SELECT count(*) FROM known) + 1.0::DOUBLE)
                      / (coalesce(df, 0) + 1)) AS n FROM hashed h LEFT JOIN spread USING (word))"""
    complete = "text IS NOT NULL" + ("" if unlabelled else " AND rating IS NOT NULL")
    return f"""
    rated AS (SELECT * FROM ({rated}) WHERE {complete}),
    {word_rows("rated")},
    members(member, salt) AS (VALUES {names}),
    sides AS (SELECT m.member, r.doc_id, r.rating, {in_train} AS in_train
              FROM rated r CROSS JOIN members m WHERE r.rating IS NOT NULL),
    vocabulary AS (SELECT word, count(*) AS n FROM words {vocabulary_rows}
                   GROUP BY word),
    {counts},
    sizes AS (SELECT doc_id, sum(n) AS n FROM counts GROUP BY doc_id),
    labelled AS ({labelled}),
    fitted AS (SELECT * FROM labelled {fitted}),
    classes AS (SELECT member, label, count(*) AS n_class,
                       sum(count(*)) OVER (PARTITION BY member) AS n_all,
                       count(*) OVER (PARTITION BY member) AS n_classes
                FROM fitted GROUP BY member, label),
    class_words AS (SELECT member, label, word, sum(n) AS n
                    FROM fitted JOIN counts USING (doc_id) GROUP BY member, label, word),
    class_sizes AS (SELECT member, label, sum(n) AS n FROM class_words GROUP BY member, label),
    hits AS (SELECT w.member, w.label, c.doc_id,
                    sum(c.n * (ln(w.n + {smooth}) - ln({smooth}))) AS gain
             FROM counts c JOIN class_words w USING (word) GROUP BY w.member, w.label, c.doc_id),
    scores AS (
        SELECT c.member, r.doc_id, c.label, c.n_class,
               ln(c.n_class + {smooth}) - ln(c.n_all + c.n_classes * {smooth})
               + coalesce(h.gain, 0)
               + coalesce(s.n, 0) * (ln({smooth}) - ln(coalesce(t.n, 0)
                   + {width} * {smooth})) AS score
        FROM classes c CROSS JOIN rated r
        LEFT JOIN class_sizes t ON t.member = c.member AND t.label = c.label
        LEFT JOIN sizes s ON s.doc_id = r.doc_id
        LEFT JOIN hits h ON h.member = c.member AND h.label = c.label AND h.doc_id = r.doc_id),
    marks AS (SELECT member, doc_id, label AS mark FROM (
        SELECT *, row_number() OVER (PARTITION BY member, doc_id
            ORDER BY score DESC, n_class DESC, label::VARCHAR) AS place FROM scores)
        WHERE place = 1)"""


def tested(
    rated: str,
    members: Sequence[tuple[str, str]],
    target: float | None = None,
    holdout: bool = True,
    scope: str = "train",
    places: int = 0,
) -> str:
    """``bayes`` and then ``tested(member, doc_id, label, prediction)``."""
    side = "WHERE NOT l.in_train" if holdout else ""
    return f"""{bayes(rated, members, target, holdout, scope, places=places)},
    tested AS (SELECT l.member, l.doc_id, l.label, p.mark AS prediction
               FROM labelled l JOIN marks p ON p.member = l.member AND p.doc_id = l.doc_id {side})"""


def vote(rows: str, key: str) -> str:
    """Plurality vote over ``rows`` with columns ``key`` and ``mark``."""
    return f"""
    SELECT {key}, avg(mark) AS mark FROM (
        SELECT {key}, mark, rank() OVER (PARTITION BY {key} ORDER BY n DESC) AS place FROM (
            SELECT {key}, CASE WHEN mark <> -1 THEN mark END AS mark,
                   count(CASE WHEN mark <> -1 THEN mark END) AS n
            FROM ({rows}) GROUP BY ALL))
    WHERE place = 1 GROUP BY {key}"""


def _times(x: str, factor: int) -> str:
    return f"(({x} * {factor}::UBIGINT) % 4294967296)"


def _turned(x: str, bits: int) -> str:
    return f"((({x} << {bits}) % 4294967296) | ({x} >> {32 - bits}))"


def _folded(x: str, bits: int) -> str:
    return f"xor({x}, {x} >> {bits})"


def hashed_places(terms: str, places: int, seed: int = 42) -> str:
    """``murmur`` as a common table expression: ``(term, bucket)`` of the 32-bit Murmur3 hash.

    ``terms`` selects ``term``.  The constants are those of the published algorithm.
    """
    octet = "('0x' || substr(h, {at}, 2))::UBIGINT"
    word = " + ".join(
        f"(CASE WHEN 8 * i + {2 * b + 1} <= length(h) THEN {octet.format(at=f'8 * i + {2 * b + 1}')} "
        f"ELSE 0 END) * {256**b}::UBIGINT"
        for b in range(4)
    )
    mixed = "w"
    for step in (_times("x", 0xCC9E2D51), _turned("x", 15), _times("x", 0x1B873593)):
        mixed = f"list_transform({mixed}, lambda x: {step})"
    state = "xor(a, x)"
    return f"""
    hexed AS (SELECT term, hex(encode(term)) AS h FROM ({terms})),
    parts AS (SELECT term, length(h) // 2 AS size,
        list_transform(range(0, (length(h) + 7) // 8), lambda i: {word}) AS w FROM hexed),
    mixed AS (SELECT term, size, {mixed} AS w FROM parts),
    body AS (SELECT term, size, CASE WHEN size % 4 = 0 THEN 0 ELSE w[-1] END::UBIGINT AS rest,
        list_reduce(list_prepend({seed}::UBIGINT, w[:size // 4]),
            lambda a, x: ({_times(_turned(state, 13), 5)} + {0xE6546B64}) % 4294967296) AS a FROM mixed),
    folded AS (SELECT term, xor(xor(a, rest), size::UBIGINT) AS x FROM body),
    folded1 AS (SELECT term, {_times(_folded("x", 16), 0x85EBCA6B)} AS x FROM folded),
    folded2 AS (SELECT term, {_times(_folded("x", 13), 0xC2B2AE35)} AS x FROM folded1),
    folded3 AS (SELECT term, {_folded("x", 16)} AS x FROM folded2),
    murmur AS (SELECT term,
        ((x::BIGINT - CASE WHEN x >= 2147483648 THEN 4294967296 ELSE 0 END) % {places} + {places}) % {places}
        AS bucket FROM folded3)"""
