"""Secret scans: pattern candidates, then a random forest that removes false positives, in DataFrame operations alone.

Candidates are long runs of key characters, and shorter values that are assigned to a secret's name. Each is described
by its length, character transitions, dictionary coverage, the path it comes from and its neighbouring words; a random
forest trained from labelled findings judges it. The fitted trees become one Column expression, so scoring runs inside
the scan's own stage.

Scale: one pass over whole texts, no shuffle; a text is only taken apart if it holds a candidate. The forest is fitted
on at most ``most_labelled`` findings, a seeded sample of them, whatever the corpus.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbria.llm.common import cut

#: A candidate: a value of 6 characters or more that is assigned to a secret's name, else 16 key characters or more that are
#: no part of a longer word or run.
CANDIDATE = (
    r"(?<![\p{L}\p{N}+/_\-])(?:"
    r"(?<=[=:\"']\s{0,2})(?<=(?i:passw(?:or)?d|pwd|secret|token|api[_\-]?key|access[_\-]?key|credentials?)[\"']?\s{0,2}[=:]\s{0,2}[\"']?)[A-Za-z0-9+/_\-!@$%^*.~]{6,}+"
    r"|[A-Za-z0-9+/_\-]{16,}+(?!\p{L}))"
)
#: Characters of the text before and after a candidate that are its neighbourhood; its own place in it.
BEFORE, AFTER, PLACE = 80, 40, "●"
MOST_LABELLED, TREES, DEPTH, SEED = 6000, 20, 6, 11
FEATURES = ["length", "digits", "uppers", "lowers", "switches", "common_pairs", "distinct", "hexadecimal", "words", "path", "key_near", "benign_near", "assigned", "prefix"]
PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea|ra|ce|li|ch|ll|be|ma|si|om|ur"
DICTIONARY = "password|username|controller|version|example|account|service|request|response|default|profile|product|project|session|message|manager|release|package|content|sample|secret|change|update|config|client|server|public|private|string|number|report|image|index|build|order|local|admin|cache|table|value|class|model|token|large|small|test|user|data|file|name|page|item|view|code|type|time|date|list|main|info|test|your|here|key|api|the|and|for|me|my"
KEY_WORDS = r"(?i)(api.?key|secret|token|passw|pwd|credential|auth|access.?key|private)"
BENIGN_WORDS = r"(?i)(?<![a-z])(example|sample|sha\d*|commit|checksum|hash|uuid|guid|md5|digest|version|placeholder|dummy|integrity|revision|order|card|phone|isbn|build)(?![a-z])[^●]{0,40}●"
BENIGN_PATHS = r"(?i)((^|[/_.\-])(tests?|specs?|examples?|samples?|fixtures?|docs?|vendor|node_modules|mocks?)([/_.\-]|$)|\.lock$|lock\.json$|\.md$|\.sum$)"
PREFIXES = r"^(AKIA|ASIA|ghp_|gho_|sk_live|sk-|xox[abp]-|AIza|glpat-)"


def features() -> dict[str, Column]:
    """The features of columns candidate, near (neighbouring words) and path; all double, null path and near as empty."""
    c, n = F.col("candidate"), F.length("candidate").cast("double")
    near, path = F.coalesce("near", F.lit("")), F.coalesce("path", F.lit(""))
    left = lambda pattern: F.length(F.regexp_replace(c, pattern, "")).cast("double")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    flag = lambda x: x.cast("double")
    return {
        "length": n,
        "digits": 1 - left("[0-9]") / n,
        "uppers": 1 - left("[A-Z]") / n,
        "lowers": 1 - left("[a-z]") / n,
        "switches": (F.length(F.regexp_replace(classes, r"(.)\1*", "$1")) - 1) / (n - 1),
        "common_pairs": F.regexp_count(c, F.lit(f"(?i)(?=(?:{PAIRS}))")) / (n - 1),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "hexadecimal": flag(c.rlike("^[0-9a-f]+$")),
        "words": 1 - left(f"(?i)({DICTIONARY})") / n,
        "path": flag(path.rlike(BENIGN_PATHS)),
        "key_near": flag(near.rlike(KEY_WORDS)),
        "benign_near": flag(near.rlike(BENIGN_WORDS)),
        "assigned": flag(near.rlike(rf"[=:]\s*[\"']?\s*{PLACE}")),
        "prefix": flag(c.rlike(PREFIXES)),
    }


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(id, path, place, candidate, near): every candidate of every whole text in order, with the nearest characters before
    and after it (``PLACE`` between; other candidates are left out of them). Null and empty texts have none."""
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    held = docs.select(F.col(id_col).alias("__id"), path.alias("__path"), F.col(text_col).alias("__text")).where(F.col("__text").rlike(CANDIDATE))
    held = held.select("__id", "__path", F.regexp_extract_all("__text", F.lit(CANDIDATE), F.lit(0)).alias("__found"), F.split("__text", CANDIDATE, -1).alias("__between"))
    last = lambda x, n: F.when(F.length(x) > n, F.substring(x, -n, n)).otherwise(x)

    def described(c: Column, i: Column) -> Column:
        before = F.concat(F.when(i > 0, last(F.get("__between", i - 1), BEFORE)).otherwise(""), F.lit(" "), last(F.get("__between", i), BEFORE))
        after = F.substring(F.get("__between", i + 1), 1, AFTER)
        return F.struct(c.alias("candidate"), F.concat(last(before, BEFORE), F.lit(PLACE), F.coalesce(after, F.lit(""))).alias("near"))

    made = held.select("__id", "__path", F.posexplode(F.transform("__found", described)).alias("place", "f"))
    return made.select(F.col("__id").alias(id_col), F.col("__path").alias("path"), "place", "f.candidate", "f.near")


def labelled_findings(spark: SparkSession, n: int = MOST_LABELLED) -> DataFrame:
    """(path, near, candidate, secret): ``n`` labelled findings made by rule, as reviewers of scans label them: keys of
    known makers and random values assigned to a secret name are secrets, short passwords among them; hashes, ids, numbers,
    placeholders, names, long words and anything in tests or documentation without a maker's prefix are not."""
    h = lambda salt: F.md5(F.concat(F.col("id").cast("string"), F.lit(salt)))
    pick = lambda values, salt: F.get(F.array(*[F.lit(v) for v in values]), F.conv(F.substring(h(salt), 1, 6), 16, 10).cast("int") % len(values))
    long = F.concat(h("a"), h("b"))
    b64 = F.regexp_replace(F.base64(F.unhex(long)), "[+/=]", "x")
    upper = F.translate(F.upper(h("c")), "0189", "GKQZ")
    letters = F.translate(upper, "0123456789", "HJLMNPRSTU")
    syllables = ["tion", "ing", "the", "er", "an", "schaft", "lich", "keit", "heit", "ver", "ment", "eau", "con", "re", "able", "os"]
    long_word = lambda n: F.concat(*[pick(syllables, f"y{i}{n}") for i in range(n)], F.substring(F.lit("erenthanontiou"), 1, 6))
    short = F.concat(F.substring(b64, 3, 6), pick(["!", "$", "_", "7", "."], "v"), F.substring(b64, 12, 4))
    names = F.concat(pick(["user", "order", "service", "account", "profile", "session", "project"], "d"), F.lit("_"), pick(["controller", "manager", "report", "version", "release"], "e"), F.lit("_"), F.substring(F.translate(h("f"), "abcdef", "123456"), 1, 3))
    digits = F.translate(h("g"), "abcdef", "246813")
    word = pick(["is", "the", "of", "and", "with", "not", "der", "les"], "w")
    secret_name = pick(["password=", "token = \"", "api_key: ", "secret = ", "auth_token=", "pwd: ", "client_secret=", "access_key = "], "s")
    plain, tests = pick(["src1", "app/settings.py", "deploy/prod.env", "src12", "notes", "config.yaml"], "p"), pick(["tests/fixtures/a.json", "docs/setup.md", "examples/run.sh", "yarn.lock"], "q")
    cases = [
        (1, plain, F.concat_ws(" ", word, word, word), F.concat(F.lit("AKIA"), F.substring(upper, 1, 16))),
        (1, plain, F.concat_ws(" ", word, secret_name), F.substring(long, 1, 40)),
        (1, plain, F.concat_ws(" ", word, secret_name), F.substring(h("h"), 1, 18)),
        (1, plain, F.concat_ws(" ", word, secret_name), F.substring(b64, 1, 32)),
        (1, plain, F.concat_ws(" ", word, word), F.concat(pick(["ghp_", "sk_live_", "xoxb-", "AIza"], "i"), F.substring(b64, 1, 34))),
        (0, plain, F.concat_ws(" ", word, pick(["commit", "sha1", "checksum:", "md5:", "revision"], "j")), F.substring(long, 1, 40)),
        (0, plain, F.concat_ws(" ", word, word, word), F.substring(digits, 1, 16)),
        (0, plain, F.concat_ws(" ", word, pick(["uuid:", "id", "guid ="], "k")), F.concat_ws("-", F.substring(h("l"), 1, 8), F.substring(h("l"), 9, 4), F.substring(h("l"), 13, 4), F.substring(h("l"), 17, 12))),
        (0, plain, F.concat_ws(" ", word, secret_name), pick(["your_api_key_here_123", "changeme1234567890", "xxxxxxxxxxxxxxxxxxx1", "password1234567890", "00000000000000000000", "1234567890123456"], "m")),
        (0, plain, F.concat_ws(" ", word, word), names),
        (0, tests, F.concat_ws(" ", word, secret_name), F.substring(long, 1, 40)),
        (1, plain, F.concat_ws(" ", word, word, word), F.concat(F.lit("AKIA"), F.substring(letters, 1, 16))),
        (1, plain, F.concat_ws(" ", word, secret_name), short),
        (1, plain, F.upper(F.concat_ws(" ", word, secret_name)), F.upper(F.substring(long, 1, 40))),
        *[(0, plain, F.concat_ws(" ", word, word, word), long_word(n)) for n in (4, 5, 6)],
        (0, plain, F.concat_ws(" ", word, word, word), F.initcap(long_word(5))),
        (0, plain, F.upper(F.concat_ws(" ", word, word, word)), F.upper(long_word(4))),
        (0, plain, F.concat_ws(" ", word, pick(["a token", "the secret", "api key", "auth"], "t"), word), long_word(4)),
        (0, plain, F.concat_ws(" ", word, secret_name), pick(["changeme", "password", "secret", "your_token", "xxxxxxxx", "string", "required", "username", "example", "default"], "z")),
        (0, plain, F.concat_ws(" ", word, word, word), F.substring(long, 1, 40)),
    ]
    made = [spark.range(k, n, len(cases)).select(p.alias("path"), F.concat(near, F.lit(PLACE), F.lit("\" "), word).alias("near"), c.alias("candidate"), F.lit(float(y)).alias("secret")) for k, (y, p, near, c) in enumerate(cases)]
    return cut(reduce(DataFrame.unionByName, made).coalesce(4))


def fit(labelled: DataFrame, most: int = MOST_LABELLED, trees: int = TREES, depth: int = DEPTH):
    """A random forest over ``labelled`` (path, near, candidate, secret; near as ``candidates`` makes it), of which a seeded
    sample of ``most`` rows is used."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = labelled.where("candidate is not null and length(candidate) > 1 and secret is not null").orderBy(F.xxhash64("candidate", "near", "path"), "candidate", "near", "path").limit(most).withColumns(features()).repartition(4)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="v").transform(rows).select("v", F.col("secret").cast("double").alias("secret"))
    return RandomForestClassifier(featuresCol="v", labelCol="secret", numTrees=trees, maxDepth=depth, seed=SEED, subsamplingRate=0.8).fit(rows)


def expression(forest) -> Column:
    """The forest's mean probability of a secret over the feature columns."""

    def walk(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            stats = list(node.impurityStats().stats())
            return F.lit(stats[1] / sum(stats))
        split = node.split()
        return F.when(F.col(FEATURES[split.featureIndex()]) <= split.threshold(), walk(node.leftChild())).otherwise(walk(node.rightChild()))

    made = [walk(tree._java_obj.rootNode()) for tree in forest.trees]
    return sum(made[1:], made[0]) / len(made)


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = 0.5) -> DataFrame:
    """(id, place, candidate, score, is_secret): every candidate of every row of ``docs`` with the forest's score.

    ``labelled`` are reviewed findings (path, near, candidate, secret; default ``labelled_findings``). ``place`` numbers a
    text's candidates from 0. Null and empty texts return no row; rows that repeat an id each return theirs; a null path
    is no test path. Very long texts are matched whole, inside the JVM's task that reads them. Columns of ``docs`` named
    like the results are not read. An empty table gives an empty result.
    """
    labelled = labelled if labelled is not None else labelled_findings(docs.sparkSession)
    forest = fit(labelled)
    found = candidates(docs, id_col, text_col, path_col).withColumns(features())
    return found.withColumn("score", F.round(expression(forest), 9)).select(id_col, "place", "candidate", "score", (F.col("score") >= threshold).alias("is_secret"))
