"""Personal data by weak supervision, in DataFrame functions only.

Base spans come from four patterns with checks (e-mail, IP, card, phone) and always stay. Further candidates (long
mixed tokens, digit groups) get votes from labelers: patterns, a gazetteer (a table of phrases), names, streets,
identifiers' checks, shape and context. They may disagree. Expectation
maximisation over the counts of vote patterns estimates each labeler's reliability and each pattern's probability;
with those as soft labels a span classifier (logistic, over shape and context features) is trained, and the spans it
accepts are added. What reaches the driver is one row for each vote pattern or feature tuple, whose numbers are fixed
by the labelers and buckets below and don't grow with the corpus.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, whole

# Java patterns. Possessive repeats give the same matches as greedy ones here, without going back; the guard before an
# e-mail keeps a run of its characters from being tried at each place, and lets a match begin where the last ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OTHER = r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])[A-Za-z0-9_]{16,}+|(?<![0-9A-Za-z])[0-9](?:[() .-]*+[0-9]){5,}+(?![0-9A-Za-z])"
KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("secret", "number")

#: The gazetteer that stands in where none is given, (phrase, kind or any, vote).
GAZETTEER = (
    *((w, "secret", 1) for w in ("password", "passwd", "passwort", "contraseña", "secret", "token", "api_key", "apikey", "api key", "access key", "private key")),
    *((w, "number", 1) for w in ("ssn", "social security", "passport", "iban", "account", "phone", "tel", "mobile", "fax", "call", "card")),
    *((w, "any", -1) for w in ("version", "page", "chapter", "isbn", "section", "figure", "table", "year")),
)
#: Given names, titles and street words in four languages.
NAMES = ("anna", "anne", "antonio", "carlos", "carmen", "claire", "david", "elena", "emma", "hans", "hugo", "ivan", "james", "jean", "john", "jose", "juan", "julia", "karl", "laura", "luis", "maria", "marie", "mark", "martin", "michael", "paul", "peter", "pierre", "robert", "sarah", "sofia", "sophie", "thomas", "mr", "mrs", "ms", "dr", "herr", "frau", "monsieur", "madame", "señor", "señora")
STREETS = ("street", "st", "road", "rd", "avenue", "ave", "lane", "drive", "strasse", "straße", "weg", "platz", "rue", "boulevard", "calle", "avenida", "plaza")
#: Characters before a candidate that the gazetteer (more, if its phrases are long) and the name labeler see, and phrases that a gazetteer may have.
CONTEXT = 24
GAZETTEER_ROWS = 5_000
VOTES = ("pattern", "gazetteer", "context", "shape", "name", "address", "identifier")

Entries = tuple[tuple[str, str, int], ...]
_SPAN = "struct<kind:string,start:int,end:int>"
_FIELDS = (*(f"v{i}" for i in range(len(VOTES))), *(f"f{i}" for i in range(4)))
_CAND = "struct<kind:string,start:int,end:int," + ",".join(f"{x}:int" for x in _FIELDS) + ">"


def gazetteer_of(table: DataFrame) -> Entries:
    """The entries of a table (phrase, kind: secret, number or any, vote: 1 or -1), to be held in the plan; null phrases are passed over.

    Only for up to GAZETTEER_ROWS phrases; a table of any size can be given as it is, and is then joined.
    """
    rows = table.filter("phrase is not null and vote is not null").select(F.lower("phrase"), F.coalesce("kind", F.lit("any")), F.signum("vote").cast("int")).distinct().limit(GAZETTEER_ROWS + 1).collect()  # a bounded policy table
    if len(rows) > GAZETTEER_ROWS:
        raise ValueError(f"more than {GAZETTEER_ROWS} phrases: give the table itself")
    return tuple(sorted(map(tuple, rows)))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """True for a string of digits that passes the Luhn check."""
    back = F.reverse(d)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(d)),
        F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, back.substr(i, F.lit(1)).cast("int")).otherwise(back.substr(i, F.lit(1)).cast("int") * 2 - F.when(back.substr(i, F.lit(1)) > "4", 9).otherwise(0)),
    )
    return total % 10 == 0


def is_kind(kind: str):
    """A test of one span's kind, for ``filter``."""
    return lambda s: s["kind"] == kind


#: Matches of a text that one inner fold gathers.
_CHUNK = 128


def spans_of(text: Column, guard: Column, pattern: str, make, kind_type: str) -> Column:
    """array<kind_type> of the matches of ``pattern`` for which ``make(match, start, before, after)`` gives a struct and not null.

    The pieces between the matches give the offsets, in code points: a fold over both adds up their lengths. It goes by
    chunks of matches, whose results are joined at the end, so that a text with very many doesn't copy what it has found
    for each of them.
    """
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    empty = F.array().cast(f"array<{kind_type}>")
    both = F.arrays_zip(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))).alias("p"), found.alias("m"), F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        got = make(x["m"], start, x["p"], x["n"])
        return F.struct((start + F.length(x["m"])).cast("int").alias("at"), F.when(got.isNotNull(), F.concat(acc["out"], F.array(got.cast(kind_type)))).otherwise(acc["out"]).alias("out"))

    def fold(all_: Column) -> Column:
        def chunk(acc: Column, at: Column) -> Column:
            inner = F.aggregate(F.slice(all_, at, F.lit(_CHUNK)), F.struct(acc["at"].alias("at"), empty.alias("out")), step)
            return F.struct(inner["at"].alias("at"), F.concat(acc["out"], F.array(inner["out"])).alias("out"))

        parts = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind_type}>>").alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(_CHUNK)), parts, chunk, lambda acc: F.flatten(acc["out"]))

    # Bound to a name by an array of one, so that the matches are found once and not for each chunk.
    folded = F.get(F.transform(F.array(both), fold), F.lit(0))
    return F.when(guard, folded).otherwise(empty)


def base_spans(text: Column) -> dict[str, Column]:
    """Kind -> array of its spans: leftmost matches that don't overlap, those that fail their check dropped."""

    def plain(kind: str, ok=None):
        def make(m: Column, start: Column, _p: Column, _n: Column) -> Column:
            s = F.struct(F.lit(kind).alias("kind"), start.cast("int").alias("start"), (start + F.length(m)).cast("int").alias("end"))
            return s if ok is None else F.when(ok(m), s)

        return make

    def octets(m: Column) -> Column:
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.concat(F.lit("0"), F.right(p, F.lit(3))).cast("int") <= 255))

    def card_ok(m: Column) -> Column:
        d = digits(m)
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)

    return {
        "email": spans_of(text, F.contains(text, F.lit("@")), EMAIL, plain("email"), _SPAN),
        "ip": spans_of(text, F.regexp(text, F.lit(IP)), IP, plain("ip", octets), _SPAN),
        "card": spans_of(text, F.regexp(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){12}")), CARD, plain("card", card_ok), _SPAN),
        "phone": spans_of(text, F.contains(text, F.lit("+")), PHONE, plain("phone", lambda m: F.length(digits(m)).between(9, 15)), _SPAN),
    }


def _any_of(phrases: tuple[str, ...]) -> Column:
    """A pattern of any of the phrases as whole words; a space in a phrase stands for one blank, underscore, hyphen or nothing."""
    return F.lit("(?<![\\p{L}])(?:" + "|".join("[ _-]?".join(map(re.escape, w.lower().split(" "))) for w in phrases) + ")(?![\\p{L}])")


def candidates(text: Column, gazetteer: Entries = GAZETTEER, told_chars: int | None = None) -> Column:
    """array<_CAND>: spans that may be personal beyond the base kinds, with a vote of each labeler (1 for, -1 against, 0 none) and four features.

    Labelers: the span's own pattern; phrases of the gazetteer before it; signs beside it; its shape; a name or title
    before it; a street word on either side; digits that pass or fail an identifier's checks. told_chars: with the last
    so many characters before it, lower-cased, as a last field.
    """

    reach = max(CONTEXT, *(len(w) + CONTEXT // 2 for w, _, _ in gazetteer), CONTEXT)  # a phrase, and signs after it

    def make(m: Column, start: Column, before: Column, after: Column) -> Column:
        left, right = F.lower(F.right(before, F.lit(CONTEXT))), F.lower(F.left(after, F.lit(CONTEXT)))
        told = left if reach == CONTEXT else F.lower(F.right(before, F.lit(reach)))
        d, width = digits(m), F.length(m)
        secret = F.regexp(m, F.lit("[A-Za-z]"))

        def has(kind: str, vote: int) -> Column:
            words = tuple(w for w, k, v in gazetteer if k == kind and v == vote)
            return F.regexp(told, _any_of(words)) if words else F.lit(False)

        said = lambda vote: (secret & has("secret", vote)) | (~secret & has("number", vote)) | has("any", vote)
        ratio = F.length(d) / width
        ssn = F.regexp(m, F.lit("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"))
        votes = {
            "pattern": F.when(secret & F.regexp(m, F.lit("^(?:[0-9a-f]{16,}|(?:sk|pk|AKIA|ghp)_?[A-Za-z0-9_]{12,})$")), 1).when(~secret & F.regexp(m, F.lit(r"^(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})$")), 1).when(secret, -1).otherwise(0),
            "gazetteer": F.when(said(1), 1).when(said(-1), -1).otherwise(0),
            "context": F.when(F.regexp(before, F.lit("[=:][ ]?[\"']?$")), 1).when(F.regexp(before, F.lit(r"[$€£#%][ ]?$")) | F.regexp(after, F.lit(r"^[ ]?(?:%|€|\$|km|kg)")), -1).otherwise(0),
            "shape": F.when(secret & ratio.between(0.2, 0.85) & (width >= 16), 1).when(secret, -1).when(~secret & F.length(d).between(9, 11), 1).when(~secret & ((F.length(d) < 8) | (F.length(d) > 19)), -1).otherwise(0),
            "name": F.when(~secret & F.regexp(left, _any_of(NAMES)), 1).otherwise(0),
            "address": F.when(~secret & (F.regexp(left, _any_of(STREETS)) | F.regexp(right, _any_of(STREETS))), 1).otherwise(0),
            # Areas that are never given out, and runs of one digit, are no identifiers.
            "identifier": F.when(~secret & (F.regexp(d, F.lit("^([0-9])\\1+$")) | (ssn & F.regexp(d, F.lit("^(?:000|666|9)|^[0-9]{3}00|0000$")))), -1).when(ssn, 1).when(secret & F.regexp(m, F.lit("^(.{1,4})\\1+$")), -1).otherwise(0),
        }
        features = (F.when(secret, 1).otherwise(0), F.least(width / 8, F.lit(5)).cast("int"), (ratio * 4).cast("int"), F.when(F.regexp(before, F.lit("[=:\"']\\s?$")), 1).otherwise(0) + F.when(F.regexp(left, F.lit(r"[a-z]\w*\W{0,4}$")), 2).otherwise(0))
        return F.struct(F.when(secret, "secret").otherwise("number").alias("kind"), start.cast("int").alias("start"), (start + width).cast("int").alias("end"), *(votes[v].cast("int").alias(f"v{i}") for i, v in enumerate(VOTES)), *(f.cast("int").alias(f"f{i}") for i, f in enumerate(features)), *([] if told_chars is None else [F.lower(F.right(before, F.lit(told_chars))).alias("told")]))

    return spans_of(text, F.regexp(text, F.lit(OTHER)), OTHER, make, _CAND if told_chars is None else _CAND[:-1] + ",told:string>")


def with_spans(df: DataFrame, text_col: str = "text", gazetteer: Entries | DataFrame = GAZETTEER) -> DataFrame:
    """Adds ``__base`` (array of base spans, by kind and start) and ``__cand`` (further candidates that overlap none of them).

    gazetteer: entries that are held in the plan, or a table (phrase, kind, vote) of any size, which is joined. Null and
    empty texts have neither; texts of any length are searched whole, equal rows alike; all columns stay.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    long = isinstance(gazetteer, DataFrame)
    told = None
    if long:
        told = max(CONTEXT, (gazetteer.agg(F.max(F.length("phrase")).alias("n")).first()["n"] or 0) + CONTEXT // 2)
    df = df.withColumns({f"__{k}": v for k, v in base_spans(text).items()} | {"__cand": candidates(text, () if long else gazetteer, told)})
    df = df.withColumn("__base", F.concat(*(F.col(f"__{k}") for k in KINDS)))
    clear = F.filter(F.col("__cand"), lambda c: ~F.exists(F.col("__base"), lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"])))
    df = df.withColumn("__cand", F.when(F.size("__cand") > 0, clear).otherwise(F.col("__cand"))).drop(*(f"__{k}" for k in KINDS))
    return _with_votes(df, gazetteer) if long else df


def _with_votes(df: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """``with_spans`` of candidates that hold the text before them: votes of a gazetteer of any size.

    A phrase is filed under the first run of letters or of digits that a text can have where it stands (its words may
    stand apart or together, so it may have several); the runs before a candidate fetch phrases, and only those are
    tried. Phrases without a letter or digit are passed over; one that begins with digits is met where they are a whole
    number.
    """
    rows = cut(df.withColumn("__at", F.monotonically_increasing_id()), "pii-candidates")
    run = r"(\p{L}+|\p{N}+)"
    words = F.split(F.lower("phrase"), " ")
    starts = F.transform(F.sequence(F.lit(1), F.size(words)), lambda j: F.regexp_extract(F.array_join(F.slice(words, 1, j), ""), run, 1))
    pattern = F.concat(F.lit(r"(?<![\p{L}])(?:"), F.array_join(F.transform(words, lambda w: F.concat(F.lit(r"\Q"), w, F.lit(r"\E"))), "[ _-]?"), F.lit(r")(?![\p{L}])"))
    phrases = gazetteer.filter(r"phrase is not null and vote is not null and not contains(phrase, '\\\\E')")
    phrases = phrases.select(F.explode(F.array_distinct(starts)).alias("start_run"), pattern.alias("pattern"), F.coalesce("kind", F.lit("any")).alias("said_kind"), F.signum("vote").cast("int").alias("vote")).filter("start_run <> ''").distinct()
    each = rows.select("__at", F.posexplode("__cand").alias("k", "c")).select("__at", "k", "c.kind", "c.told", F.explode(F.array_distinct(F.regexp_extract_all("c.told", F.lit(run), F.lit(1)))).alias("run"))
    fits = (F.col("run") == F.col("start_run")) & ((F.col("said_kind") == F.col("kind")) | (F.col("said_kind") == "any")) & F.regexp("told", F.col("pattern"))
    votes = each.join(phrases, fits).groupBy("__at", "k").agg(F.when(F.max("vote") > 0, 1).when(F.min("vote") < 0, -1).otherwise(0).alias("vote"))
    votes = votes.groupBy(F.col("__at").alias("__of")).agg(F.map_from_entries(F.collect_list(F.struct("k", "vote"))).alias("__votes"))
    voted = VOTES.index("gazetteer")
    fields = [x.split(":")[0] for x in _CAND[len("struct<") : -1].split(",")]
    said = lambda c, k: F.struct(*((F.coalesce(F.try_element_at("__votes", k), c[x]) if x == f"v{voted}" else c[x]).alias(x) for x in fields))
    out = rows.join(votes, F.col("__at") == F.col("__of"), "left").withColumn("__cand", F.transform("__cand", said))
    return out.drop("__at", "__of", "__votes")


@dataclass(frozen=True)
class SpanModel:
    """The trained span classifier and, for the record, the labelers' estimated reliabilities."""

    weights: tuple[float, ...]
    reliability: tuple[tuple[str, float, float], ...]  # labeler, P(for | personal), P(for | not)
    threshold: float = 0.5

    def accepts(self, c: Column) -> Column:
        score = F.lit(float(self.weights[0]))
        for w, x in zip(self.weights[1:], _features(lambda k: c[k]), strict=True):
            score = score + F.lit(float(w)) * x
        return score >= math.log(self.threshold / (1 - self.threshold))


def _features(get) -> list:
    """Numbers that the classifier weighs; ``get`` gives a feature as a column, or as a number on the driver."""
    return [get("f0"), get("f1") / 5, get("f2") / 4, (get("f3") % 2) * 1.0, get("f0") * (get("f3") % 2), get("f0") * get("f2") / 4, get("f0") * get("f1") / 5]


def estimate(patterns: list[tuple[tuple[int, ...], float]], rounds: int = 100) -> tuple[dict[tuple[int, ...], float], list[list[dict[int, float]]]]:
    """Expectation maximisation over (votes, count): each vote pattern's probability, and P(vote | class) by labeler.

    Begins with the majority vote; Dirichlet pseudo-counts that trust a labeler's sign keep rare votes from deciding.
    """
    post = {v: min(0.9, max(0.1, 0.5 + 0.2 * sum(v))) for v, _ in patterns}
    table: list[list[dict[int, float]]] = []
    for _ in range(rounds):
        total = sum(n for _, n in patterns) + 2.0
        prior = (sum(n * post[v] for v, n in patterns) + 1.0) / total
        table = []
        for k in range(len(VOTES)):
            rows = []
            for y in (0, 1):
                seen = {s: 4.0 + 4.0 * (s == (1 if y else -1)) for s in (-1, 0, 1)}
                for v, n in patterns:
                    seen[v[k]] += n * (post[v] if y else 1 - post[v])
                all_ = sum(seen.values())
                rows.append({s: c / all_ for s, c in seen.items()})
            table.append(rows)
        new = {}
        for v, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[k][1][s] / table[k][0][s]) for k, s in enumerate(v))
            new[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        moved = max(abs(new[v] - post[v]) for v in new)
        post = new
        if moved < 1e-7:
            break
    return post, table


def logistic(rows: list[tuple[list[float], float, float]], l2: float = 1.0, rounds: int = 30) -> list[float]:
    """Weights (intercept first) of a logistic model over (features, soft label, count), by damped Newton steps."""
    n = len(rows[0][0]) + 1
    w = [0.0] * n
    for _ in range(rounds):
        grad, hess = [l2 * x for x in w], [[l2 * (i == j) for j in range(n)] for i in range(n)]
        for xs, y, c in rows:
            x = [1.0, *xs]
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x, strict=True))))))
            for i in range(n):
                grad[i] += c * (p - y) * x[i]
                for j in range(n):
                    hess[i][j] += c * max(p * (1 - p), 1e-6) * x[i] * x[j]
        # Gaussian elimination on the small system.
        m = [[*hess[i], grad[i]] for i in range(n)]
        for i in range(n):
            k = max(range(i, n), key=lambda r: abs(m[r][i]))
            m[i], m[k] = m[k], m[i]
            for r in range(i + 1, n):
                f = m[r][i] / m[i][i]
                m[r] = [a - f * b for a, b in zip(m[r], m[i], strict=True)]
        step = [0.0] * n
        for i in reversed(range(n)):
            step[i] = (m[i][n] - sum(m[i][j] * step[j] for j in range(i + 1, n))) / m[i][i]
        size = max(map(abs, step))
        w = [a - b * min(1.0, 2.0 / size) for a, b in zip(w, step, strict=True)] if size else w
        if size < 1e-8:
            break
    return w


def train(spans: DataFrame) -> SpanModel:
    """Trains the span classifier on the candidates of ``with_spans``; without candidates it accepts nothing."""
    votes, features = list(_FIELDS[: len(VOTES)]), list(_FIELDS[len(VOTES) :])
    seen = spans.select(F.explode("__cand").alias("c")).select(*(F.col(f"c.{x}") for x in votes + features)).groupBy(*votes, *features).count().collect()  # at most 3 ** 4 * 2 * 2 * 3 votes and 2 * 6 * 5 * 4 features
    if not seen:
        return SpanModel((-30.0, *[0.0] * 7), ())
    seen.sort(key=lambda r: tuple(r[x] for x in votes + features))  # the same sums in the same order each time
    counts: dict[tuple[int, ...], float] = {}
    for r in seen:
        v = tuple(r[x] for x in votes)
        counts[v] = counts.get(v, 0) + r["count"]
    post, table = estimate(list(counts.items()))
    weights = logistic([(_features(lambda k, r=r: r[k]), post[tuple(r[x] for x in votes)], float(r["count"])) for r in seen])
    return SpanModel(tuple(weights), tuple((name, table[k][1][1], table[k][0][1]) for k, name in enumerate(VOTES)))


def all_spans(model: SpanModel) -> Column:
    """array<_SPAN>: base spans, then accepted ones by kind and start."""
    kept = F.filter(F.col("__cand"), model.accepts)
    return F.concat(F.col("__base"), *(F.transform(F.filter(kept, is_kind(k)), lambda c: F.struct(*(c[x].alias(x) for x in ("kind", "start", "end")))) for k in EXTRA_KINDS))


def find_spans(df: DataFrame, keys: list[str], text_col: str = "text", model: SpanModel | None = None, gazetteer: Entries | DataFrame = GAZETTEER) -> DataFrame:
    """keys, base and spans (arrays of kind, start, end; code points, end exclusive) of every row; the texts are read once.

    Null or empty text: no spans. Texts of any length are searched whole, in time that grows with their length. Equal
    rows are repeated and judged alike. An empty table gives no rows. Columns outside ``keys`` are left out, whatever
    their names. ``model``: one trained before; else it is trained on these rows' candidates.
    """
    src = df.select(F.struct(*(F.col(f"`{k}`").alias(k) for k in keys)).alias("row"), F.col(f"`{text_col}`").alias("text"))
    found = cut(with_spans(src, gazetteer=gazetteer).drop("text"), "pii-spans")
    model = model or train(found)
    return found.select(*(F.col("row")[k].alias(k) for k in keys), F.col("__base").alias("base"), all_spans(model).alias("spans"))


def redact(df: DataFrame, model: SpanModel | None = None, text_col: str = "text", gazetteer: Entries | DataFrame = GAZETTEER) -> DataFrame:
    """``df`` with every span of its text replaced by its kind in brackets, ``[EMAIL]``; overlapping spans fall to the first.

    Without ``model`` one is trained on the candidates of these rows, whose spans are written beside them and found once.
    All rows and columns stay, whatever their names; null texts stay null, empty ones empty, equal rows are treated
    alike, long texts whole; an empty table gives no rows.
    """
    marked = with_spans(df.select(whole(df), F.col(f"`{text_col}`").alias("text")), gazetteer=gazetteer).drop("text")
    if model is None:
        marked = cut(marked, "pii-marked")
        model = train(marked)
    marked = marked.withColumn("text", F.col("row")[text_col])
    text = F.col("text")
    ordered = F.array_sort(F.transform(all_spans(model), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        cuts = F.concat(acc["out"], F.array(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], cuts).otherwise(acc["out"]).alias("out"))

    redone = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.lit(2**31 - 1))))
    marked = marked.withColumn("text", F.when(F.size("__base") + F.size("__cand") > 0, redone).otherwise(text))
    return marked.select(*((F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in df.columns))
