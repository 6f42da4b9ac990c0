"""Secret scans with a random forest that removes false positives, in DataFrame operations only.

Candidates are long runs of key characters, values of any kind assigned to the name of a secret,
and passwords in URLs, with the text around them. Each is described by its
length, its kinds of characters and the transitions between them, the share of it that words of
the corpus cover, whether it stands in a path, and the neighbouring words. A random forest trained
on labelled findings says which candidates are secrets.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgrade.functions.steps import compute
from claimgrade.llm.common import stored

# A candidate: so many key characters in a row
LEAST = 16
_KEY = "A-Za-z0-9+/_=\\-"
# Marks round a candidate, and before one that is far from its name or after a long user name
_BEGIN, _END, _FAR_VALUE, _FAR_PASSWORD = "\x01", "\x02", "\x03", "\x04"
_MARKS = _BEGIN + _END + _FAR_VALUE + _FAR_PASSWORD
# Characters of context that are looked at on either side
CONTEXT = 80
# Bound of the labelled sample, in findings
SAMPLE = 20_000
# Candidates of a text that are put together at a time
BLOCK = 64
# A dictionary word has so many letters and occurs so often in the corpus
WORD_LETTERS, WORD_COUNT = 4, 3
TREES, DEPTH, SEED = 30, 6, 1

# Words that name a secret, words that name something made up, formats of issuers
NAMES = r"pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth"
MADE_UP = r"example|sample|dummy|test|fake|placeholder|changeme|docs?"
ISSUED = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{24,}|AIza[A-Za-z0-9_-]{35})$"

# A value assigned to a name: quoted, or up to white space; a single character (a flag) is none.
# Cheap looks behind come first. A run that holds its name goes on as a run if the value does.
# A look behind has a bound: names farther off (NEAR blanks, USER characters) are marked before.
NEAR, USER = 8, 64
_EQUALS = "(?:=>|:=|[:=])"
_SIGN = rf"[\"']?[ \t]{{0,{NEAR}}}{_EQUALS}[ \t]{{0,{NEAR}}}"
_PLAIN = r"[^\s\"']+[^\s\"',;.)\]}]"
_NAMED = rf"(?i:{NAMES})".replace("(word", "(?:word")
_ASSIGNED = (
    rf"(?<=[:=> \t])(?<=[:=>][ \t]{{0,{NEAR}}})(?<={_NAMED}{_SIGN}){_PLAIN}"
    rf"|(?<=\")(?<=[:=>][ \t]{{0,{NEAR}}}\")(?<={_NAMED}{_SIGN}\")[^\"\r\n]{{2,}}(?=\")"
    rf"|(?<=')(?<=[:=>][ \t]{{0,{NEAR}}}')(?<={_NAMED}{_SIGN}')[^'\r\n]{{2,}}(?=')"
)
_IN_URL = rf"(?<=:)(?<=://[^\s/:@]{{0,{USER}}}:)[^\s/@]{{2,}}(?=@)"
_HIDDEN = rf"[{_KEY}]*{_NAMED}=[{_KEY}]*+[^\s\"']*[^\s\"',;.)\]}}]"
_RUN = rf"{_ASSIGNED}|{_IN_URL}|(?<![{_KEY}])(?=[{_KEY}]{{{LEAST}}})(?!{_HIDDEN})[{_KEY}]{{{LEAST},}}"

_FAR = rf"[ \t]{{{NEAR + 1}}}|://[^\s/:@]{{{USER + 1}}}"
_FAR_NAME = rf"{_NAMED}[\"']?(?:[ \t]{{{NEAR + 1},}}+{_EQUALS}[ \t]*+|[ \t]*+{_EQUALS}[ \t]{{{NEAR + 1},}}+)"
_FAR_USER = rf"://[^\s/:@]{{{USER + 1},}}+:"
_FAR_RUN = (
    rf"(?<={_FAR_VALUE}){_PLAIN}|(?<={_FAR_VALUE}\")[^\"\r\n]{{2,}}(?=\")"
    rf"|(?<={_FAR_VALUE}')[^'\r\n]{{2,}}(?=')|(?<={_FAR_PASSWORD})[^\s/@]{{2,}}(?=@)|{_RUN}"
)

_KINDS = "uldo"
_TRANSITIONS = [a + b for a in _KINDS for b in _KINDS if a != b]
FEATURES = [
    "length", "upper", "lower", "digits", "others", "distinct", "hex", *(f"to_{t}" for t in _TRANSITIONS),
    "coverage", "in_path", "path_made_up", "named", "assigned", "quoted", "made_up_near", "left_covered", "right_covered", "issued",
]


def _marked(text: F.Column) -> F.Column:
    """``text`` with the marks round its candidates."""

    def around(t: F.Column, run: str) -> F.Column:
        return F.regexp_replace(t, f"({run})", f"{_BEGIN}$1{_END}")

    far = F.regexp_replace(F.regexp_replace(text, f"({_FAR_NAME})", f"$1{_FAR_VALUE}"), f"({_FAR_USER})", f"$1{_FAR_PASSWORD}")
    return F.when(text.rlike(_FAR), around(far, _FAR_RUN)).otherwise(around(text, _RUN))


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str | None = "source") -> DataFrame:
    """One row per candidate: ``doc_id``, ``start`` (characters before it), ``candidate``, ``left``
    and ``right`` (context), ``path``. Whole texts are read; a text without a run gives no row.

    A text is cut at its candidates once; what stands between two is reduced to its length and
    the context at its ends, and the candidates are put together in blocks, so that a text takes
    time by its length and the number of its candidates. Each step is computed once.
    """
    place = F.lit("") if path is None else F.coalesce(F.col(f"`{path}`").cast("string"), F.lit(""))
    clean = F.translate(F.col(f"`{text}`"), _MARKS, " " * len(_MARKS))
    found = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), place.alias("path"), clean.alias("t"))
    found = compute(found, parts=F.split(_marked(F.col("t")), _BEGIN, -1)).drop("t").where(F.size("parts") > 1)

    def piece(p: F.Column) -> F.Column:
        plain = F.translate(p, _MARKS, "")
        return F.struct(
            F.length(plain).alias("n"),
            F.when(F.length(plain) > CONTEXT, F.substring(plain, -CONTEXT, CONTEXT)).otherwise(plain).alias("tail"),
            F.substring_index(p, _END, 1).alias("candidate"),
            F.substring(F.translate(F.substring_index(p, _END, -1), _MARKS, ""), 1, CONTEXT).alias("right"),
        )

    # the first part is what stands before the first candidate: it has a length and a tail
    found = compute(found, pieces=F.transform("parts", piece)).drop("parts")
    blocks = F.sequence(F.lit(0), F.expr(f"(size(pieces) - 1) div {BLOCK}"))

    def total(lengths: F.Column) -> F.Column:
        return F.aggregate(lengths, F.lit(0), lambda n, x: n + x)

    def length_of(b: F.Column) -> F.Column:
        return total(F.transform(F.slice("pieces", b * BLOCK + 1, F.lit(BLOCK)), lambda p: p["n"]))

    # a candidate right before belongs to the context too; each has two characters at least
    reach = CONTEXT // 2 + 1
    found = compute(found, lengths=F.transform(blocks, length_of))

    def block_of(b: F.Column) -> F.Column:
        at = b * BLOCK
        return F.struct(
            (b == 0).alias("first"),
            total(F.slice("lengths", F.lit(1), b)).alias("offset"),
            F.slice("pieces", at + 1, F.lit(BLOCK)).alias("own"),
            F.slice("pieces", F.greatest(at + 1 - reach, F.lit(1)), F.least(at, F.lit(reach))).alias("earlier"),
        )

    made = F.transform(blocks, block_of)
    found = compute(found, blocks=made).drop("pieces", "lengths").select("doc_id", "path", F.inline("blocks"))
    found = compute(found, tails=F.concat(F.col("earlier.tail"), F.col("own.tail")), sizes=F.col("own.n"), before=F.size("earlier"))

    def row(p: F.Column, i: F.Column) -> F.Column:
        at = F.col("before") + i
        near = F.array_join(F.slice("tails", F.greatest(at - reach + 1, F.lit(1)), F.least(at, F.lit(reach))), "")
        return F.struct(
            (F.col("offset") + total(F.slice("sizes", F.lit(1), i))).alias("start"),
            p["candidate"].alias("candidate"),
            F.when(F.length(near) > CONTEXT, F.substring(near, -CONTEXT, CONTEXT)).otherwise(near).alias("left"),
            p["right"].alias("right"),
            (F.col("first") & (i == 0)).alias("none"),
        )

    rows = found.select("doc_id", "path", F.inline(F.transform("own", row)))
    return rows.where("NOT none").select("doc_id", "path", "start", "candidate", "left", "right")


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word): the lower-case words of letters that occur at least ``WORD_COUNT`` times in all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.col(f"`{text}`")), r"[^\p{L}]+")).alias("word"))
    return words.where(F.length("word") >= WORD_LETTERS).groupBy("word").count().where(F.col("count") >= WORD_COUNT).select("word")


def _pieces(text: F.Column) -> F.Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: F.length(w) >= WORD_LETTERS)


def _near(side: str, last: bool) -> F.Column:
    """The nearest word of letters on one side."""
    words = _pieces(F.col(side))
    return F.get(words, F.size(words) - 1) if last else F.get(words, F.lit(0))


def _letters(text: F.Column, at_once: int = 4096) -> F.Column:
    """The different characters of a text; long ones are read in stretches, to bound the array."""
    stretches = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(at_once))
    each = F.transform(stretches, lambda i: F.array_distinct(F.split(F.substring(text, i, F.lit(at_once)), "")))
    return F.when(F.length(text) <= at_once, F.array_distinct(F.split(text, ""))).otherwise(F.array_distinct(F.flatten(each)))


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the ``FEATURES``; ``words`` is the dictionary."""
    c = F.col("candidate")
    size = F.greatest(F.length(c), F.lit(1))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]", "-"), "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d")
    row = stored(found.withColumn("__row", F.monotonically_increasing_id()), "candidates")
    asked = row.select("__row", F.explode(_pieces(c)).alias("word"), F.lit("coverage").alias("kind"))
    asked = asked.unionAll(row.select("__row", _near("left", True).alias("word"), F.lit("left_covered").alias("kind")))
    asked = asked.unionAll(row.select("__row", _near("right", False).alias("word"), F.lit("right_covered").alias("kind")))
    # only the words asked for meet the dictionary
    known = stored(stored(asked.where("word IS NOT NULL"), "words").join(words, "word", "left_semi"), "known-words")

    def letters(kind: str) -> F.Column:
        return F.sum(F.when(F.col("kind") == kind, F.length("word"))).alias(f"__{kind}")

    sums = known.groupBy("__row").agg(letters("coverage"), letters("left_covered"), letters("right_covered"))
    full = row.join(sums, "__row", "left").withColumn("__kinds", F.regexp_replace(kinds, "-", "o"))
    k = F.col("__kinds")
    made = {
        "length": size,
        **{n: F.regexp_count(k, F.lit(x)) / size for n, x in (("upper", "u"), ("lower", "l"), ("digits", "d"), ("others", "o"))},
        "distinct": F.size(_letters(c)) / F.least(size, F.lit(64)),
        "hex": c.rlike("^[0-9a-f]+$") | c.rlike("^[0-9A-F]+$"),
        **{f"to_{t}": F.regexp_count(k, F.lit(f"{t[0]}(?={t[1]})")) / size for t in _TRANSITIONS},
        "coverage": F.coalesce("__coverage", F.lit(0)) / size,
        "in_path": c.contains("/") | F.col("left").rlike(r"[/\\.@]$") | F.col("right").rlike(r"^[.\\@]\w"),
        "path_made_up": F.lower("path").rlike(MADE_UP),
        "named": F.lower(F.concat("left", c)).rlike(rf"({NAMES})[\"']?\s*[:=]?\s*[\"']?[^\s]*$"),
        "assigned": F.concat("left", c).rlike(r"[=:]\s*[\"']?[^\s=:]+=*$"),
        "quoted": F.col("left").rlike("[\"']$") & F.col("right").rlike("^[\"']"),
        "made_up_near": F.lower(F.concat("left", F.lit(" "), c, F.lit(" "), "right")).rlike(rf"\b({MADE_UP})\b"),
        "left_covered": F.col("__left_covered").isNotNull(),
        "right_covered": F.col("__right_covered").isNotNull(),
        "issued": c.rlike(ISSUED),
    }
    out = full.withColumns({n: F.coalesce(v.cast("double"), F.lit(0.0)) for n, v in made.items()})
    return out.drop("__kinds", "__coverage", "__left_covered", "__right_covered")


def findings(found: DataFrame) -> DataFrame:
    """``found`` with ``is_finding`` 1, 0 or null: findings that reviewers would label at sight.
    An issuer's format, or a value with digits assigned to a name of a secret, is one; a run
    without digits that no name stands before, or something made up, is none. The others are not
    labelled."""
    value = F.regexp_extract("candidate", r"([^=]*)=*$", 1)
    given = F.lower(F.concat("left", "candidate"))
    within = given.rlike(rf"\b({NAMES})[\"']?\s*[:=]\s*[\"']?[a-z0-9+/_=-]+$")
    before = F.col("left").rlike(rf"{_NAMED}{_SIGN}[\"']?$") | F.col("left").rlike(r"://[^\s/:@]*:$")
    digits = F.col("candidate").rlike("[0-9]")
    named = (within | before) & digits
    made_up = F.lower("candidate").rlike(MADE_UP) | value.rlike(r"^(.)\1*$")
    label = F.when(made_up, 0).when(F.col("candidate").rlike(ISSUED), 1).when(~digits & ~before, 0).when(named, 1)
    return found.withColumn("is_finding", label.cast("double"))


def train(labelled: DataFrame) -> RandomForestClassificationModel | float:
    """The forest from described rows with ``is_finding``, at most ``SAMPLE`` of them in the order
    of a hash; with labels of one kind only their value, and 0 without any."""
    order = [F.xxhash64("candidate", "left", "right"), "candidate", "left", "right"]
    sample = stored(labelled.where("is_finding IS NOT NULL").orderBy(*order).limit(SAMPLE).select("is_finding", *FEATURES), "labelled-findings")
    kinds = [r["is_finding"] for r in sample.select("is_finding").distinct().collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else 0.0
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(featuresCol="features", labelCol="is_finding", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(vectors)


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str | None = "source", labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate: ``doc_id``, ``start``, ``candidate``, ``score`` (0 to 1), ``is_secret``.

    ``labelled`` holds findings with the columns of ``candidates`` and ``is_finding``; without it,
    the candidates that ``findings`` labels at sight are used. Null and empty texts have no
    candidates; equal texts get equal findings.
    """
    words = dictionary(docs, text)
    rows = stored(described(candidates(docs, text, doc_id, path), words), "described")
    model = train(findings(rows) if labelled is None else described(labelled, words))
    if isinstance(model, float):
        scored = rows.withColumn("score", F.lit(model))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
        scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select(F.col("doc_id").alias(doc_id), "start", "candidate", "score", (F.col("score") >= 0.5).alias("is_secret"))
