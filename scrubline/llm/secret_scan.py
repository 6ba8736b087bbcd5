"""Secret scan with a random forest against false positives.

Candidates are all long runs of key characters, with or without a digit, found in
whole texts; a word may hold several. Each gets features: its length, changes of
character class, shares of digits, capitals and vowels, distinct characters, known
prefixes, coverage by a small dictionary, its path, and the neighbouring words. A random forest trained on labelled findings
(:func:`labelled_findings`) scores them.

The trained forest becomes one column expression, so a document is scanned,
scored and redacted within its own row: no shuffle, no join, and a hot source
or repeated ids change nothing. DataFrame and ML-pipeline functions only.

Null and empty texts have no candidates. Extra columns are ignored by
:func:`scan` and kept by :func:`redact`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, let

MIN_LENGTH = 16
THRESHOLD = 0.5
MASK = "<SECRET>"
TREES, DEPTH, SEED = 20, 6, 7
#: Labelled findings that the forest is trained on.
FINDINGS = 4000
#: Parts of a word that are looked through for the name of a list of keys.
LIST_BACK = 8

#: A sign of equality is part of a key as its padding only: what stands before it
#: is a name.
_CANDIDATE = (r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}"
              r"(?:={1,2}(?![A-Za-z0-9+/_=-]|[\"'`][A-Za-z0-9+/]))?" % MIN_LENGTH)
#: Words that make a key likely or unlikely next to a candidate, places where
#: samples live, and word pieces of identifiers (fixed values).
_FOR = r"(?i)secret|token|passw|pwd|api[_-]?key|apikey|auth|bearer|credential|private|access"
_AGAINST = r"(?i)sha\d*|commit|md5|checksum|digest|hash|uuid|guid|version|example|sample|dummy|http"
_SAMPLE_PATH = r"(?i)test|example|sample|fixture|mock|docs?/"
_DICTIONARY = ("(?i)example|sample|test|dummy|placeholder|changeme|your|version|release|package|"
               "file|image|index|page|user|name|date|time|node|module|class|function|config|"
               "default|service|server|client|value|number|string|array|object|build|linux|windows|"
               "python|script|install|update|report|document|section|chapter|figure|table")

#: How issuers begin their keys, and the vowels that words are full of.
_PREFIX = (r"^(?:A(?:KI|SI|RO)A[A-Z0-9]{12}|AIza|gh[pousr]_|github_pat_|glpat-|[sr]k_(?:live|test)_|"
           r"xox[abprs]-|eyJ[A-Za-z0-9]|npm_|pypi-)")
_VOWELS = "(?i)[aeiou]"

FEATURES = ("length", "changes", "digits", "capitals", "distinct", "dictionary", "sample_path",
            "word_for", "word_against", "assigned", "quoted", "hex_only", "grouped",
            "vowels", "prefix", "name")


def _share(token: Column, drop: str) -> Column:
    return 1.0 - F.length(F.regexp_replace(token, drop, "")) / F.length(token)


def feature_struct(token: Column, word: Column, before: Column, after: Column,
                   path: Column) -> Column:
    """The forest's features of one candidate, all doubles."""
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        F.regexp_replace(token, "[a-z]+", "\u0001"), "[A-Z]+", "\u0002"), "[0-9]+", "\u0003"),
        r"[^\u0001-\u0003]+", "\u0004")
    near = F.concat_ws(" ", before, F.replace(word, token, F.lit(" ")))
    values = (
        F.length(token).cast("double"), (F.length(classes) / F.length(token)).cast("double"),
        _share(token, "[0-9]+"), _share(token, "[A-Z]+"),
        F.size(F.array_distinct(F.split(token, ""))) / F.least(F.length(token), F.lit(40)),
        _share(token, _DICTIONARY), flag(path.rlike(_SAMPLE_PATH)), flag(near.rlike(_FOR)),
        flag(F.concat_ws(" ", near, after).rlike(_AGAINST)), flag(near.rlike("[=:]")),
        flag(word.rlike("[\"'`]")), flag(token.rlike("^[0-9a-f]+$|^[0-9A-F]+$")),
        flag(token.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-")),
        _share(token, _VOWELS), flag(token.rlike(_PREFIX)),
        # The name of a value, not a value.
        flag(F.replace(word, token, F.lit("\u0001")).rlike("\u0001[\"'`]?[=:]")))
    return F.struct(*[v.cast("double").alias(n) for n, v in zip(FEATURES, values)])


def _finding(i: Column) -> Column:
    """The labelled finding of one row number."""
    hexs = F.sha2(i.cast("string"), 256)
    b64 = F.regexp_replace(F.base64(F.unhex(hexs)), "=+$", "")
    pick = lambda opts, k: F.element_at(F.array(*[F.lit(o) for o in opts]),
                                        (F.pmod(F.xxhash64(i, F.lit(k)), F.lit(len(opts))) + 1)
                                        .cast("int"))
    cut = (F.lit(20) + F.pmod(F.xxhash64(i, F.lit(5)), F.lit(24))).cast("int")
    cue = pick(["token", "secret", "password", "api_key", "AUTH_TOKEN", "private_key",
                "access_key", "Bearer", "credential"], 1)
    prose = pick(["the", "and", "of", "see", "at", "from", "was", "in"], 2)
    against = pick(["commit", "sha256", "md5", "checksum", "uuid", "version", "digest"], 3)
    keys = [F.substring(hexs, 1, 32), F.substring(hexs, 1, 40), hexs, F.substr(b64, F.lit(1), cut),
            F.concat(F.lit("AKIA"), F.upper(F.substring(hexs, 1, 16))),
            F.concat(F.lit("sk_live_"), F.substr(b64, F.lit(1), cut))]
    uuid = F.concat_ws("-", *[F.substring(hexs, a, k) for a, k in
                              ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    noise = [F.concat(prose, F.lit("-test-file-"), F.pmod(i, F.lit(900)), F.lit("-release")),
             F.concat(F.lit("example_user_"), F.pmod(i, F.lit(99999)), F.lit("_name")),
             F.concat(F.lit("docs/page/section/"), F.pmod(i, F.lit(999)), F.lit("/index")),
             F.rpad(F.pmod(F.abs(F.xxhash64(i)), F.lit(10 ** 15)).cast("string"), 17, "0"),
             F.concat(F.lit("2024-01-02T03-"), F.pmod(i, F.lit(60)), F.lit("-00-release")),
             F.concat(F.lit("xxxxxxxxxxxxxxxxxxxx"), F.pmod(i, F.lit(9))), uuid]
    of = lambda opts: F.element_at(F.array(*opts), (
        F.pmod(F.xxhash64(i, F.lit(4)), F.lit(len(opts))) + 1).cast("int"))
    # Keys and runs without a digit.
    spelt = F.translate(hexs, "0123456789", "ghkmpqrtwx")
    mixed = F.translate(b64, "0123456789+/", "kQzWmXpRvTsY")
    said = lambda k: pick(["correct", "horse", "battery", "staple", "winter", "purple",
                           "monkey", "dragon", "orange", "silver", "rocket", "coffee"], k)
    long_word = pick(["internationalization", "telecommunications", "straightforwardness",
                      "Geschwindigkeitsbegrenzung", "anticonstitutionnellement",
                      "responsabilidades-generales", "state-of-the-art-systems",
                      "institutionalisation", "aaaaaaaaaaaaaaaaaaaaaaaa", "----------------------",
                      "________________________", "abcdefghijklmnopqrstuvwxyz"], 21)
    in_code = F.concat(pick(["get", "set", "load", "make"], 22),
                       pick(["Default", "Current", "Access", "Secret"], 23),
                       pick(["Configuration", "Token", "Password", "Connection"], 24),
                       pick(["Provider", "Manager", "FromRequest", "Value"], 25))
    snake = F.lower(F.concat_ws("_", pick(["aws", "my", "client", "default"], 26),
                                pick(["secret", "access", "private", "config"], 23),
                                pick(["token", "storage", "account", "service"], 24),
                                pick(["key", "name", "value", "path"], 25)))
    folders = F.concat_ws("/", said(27), said(28), said(29), pick(["index", "readme", "main"], 30))
    prefixed = [F.concat(F.lit("AKIA"), F.upper(F.substring(spelt, 1, 16))),
                F.concat(F.lit("AKIA"), F.upper(F.substring(hexs, 1, 16))),
                F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36)),
                F.concat(F.lit("ghp_"), F.substring(b64, 1, 36))]
    letter_keys = [F.upper(F.substring(spelt, 1, 20)), F.substr(mixed, F.lit(1), cut),
                   F.substring(spelt, 1, 24), F.concat(said(31), said(32), said(33), said(34)),
                   F.concat_ws("-", said(31), said(32), said(33), said(34))]
    letter_noise = [long_word, in_code, snake, folders, F.upper(long_word),
                    F.concat_ws("-", said(35), said(36), said(37)),
                    F.upper(F.concat(said(35), said(36), said(37)))]
    kind = F.pmod(i, F.lit(10))
    bare = kind == 6
    secret = (kind < 3) | kind.isin(6, 7)
    token = (F.when(kind < 3, of(keys)).when(kind == 3, of(keys[:3])).when(kind < 6, of(noise))
             .when(bare, of(prefixed)).when(kind == 7, of(letter_keys)).otherwise(of(letter_noise)))
    cued = F.concat(cue, pick([" =", ":", " :", "="], 6))
    plain_name = F.concat(pick(["class", "name", "title", "import", "path"], 38),
                          pick([" =", ":", "="], 39))
    before = (F.when(bare & (F.pmod(i, F.lit(20)) < 10), prose).when(secret, cued)
              .when(kind == 3, F.concat(against, pick(["", ":", " ="], 7)))
              .when(kind == 8, plain_name)
              # A cue word in a sentence assigns nothing.
              .when((kind == 9) & (F.pmod(i, F.lit(20)) < 10), F.concat(F.lit("the "), cue))
              .otherwise(prose))
    quoted = F.concat(F.lit('"'), token, F.lit('"'))
    word = F.when((secret | (kind == 8)) & (F.pmod(F.floor(i / 10), F.lit(4)) > 0), quoted).when(
        (kind == 9) & (F.pmod(F.floor(i / 10), F.lit(3)) == 0), F.concat(token, F.lit('="')))
    return F.struct(
        token.alias("token"), F.coalesce(word, token).alias("word"), before.alias("before"),
        prose.alias("after"), pick(["src/app", "lib/core", "src0"], 8).alias("path"),
        secret.cast("double").alias("label"))


def labelled_findings(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """Labelled findings, derived from row numbers: keys as they stand in code and
    settings, with and without digits, and what is often mistaken for them
    (digests, ids, paths, numbers, placeholders, long words, names in code)."""
    # One partition: the forest is the same on any cluster. Inside a lambda, so that
    # the code of the rows is not generated (64 KB per method).
    return (spark.range(0, n, 1, 1).select(let(F.col("id"), _finding).alias("r")).select("r.*")
            .repartition(1))


def train_forest(spark: SparkSession, findings: DataFrame | None = None):
    """A random forest over the features of the labelled findings."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = labelled_findings(spark) if findings is None else findings
    x = rows.select("label", feature_struct(*[F.col(c) for c in (
        "token", "word", "before", "after", "path")]).alias("f")).select("label", "f.*")
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(x)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(vec.select("label", "features"))


def forest_expression(model, f: Column) -> Column:
    """The forest's probability of the positive class as one expression over a
    feature struct."""
    def node(n) -> Column:
        if n.subtreeDepth() == 0:
            stats = n.impurityStats()
            total = stats.count()
            counts = list(stats.stats())
            return F.lit(float(counts[1]) / max(float(sum(counts)), 1.0) if total else 0.0)
        split = n.split()
        return F.when(f[FEATURES[split.featureIndex()]] <= float(split.threshold()),
                      node(n.leftChild())).otherwise(node(n.rightChild()))

    trees = [node(t._java_obj.rootNode()) for t in model.trees]
    total = trees[0]
    for t in trees[1:]:
        total = total + t
    return total / len(trees)


def _in_word(x: Column) -> Column:
    """array<struct<i, t, w, b, a>> of all candidates of one word: each with its own
    part of the word, so that the name of one value is not taken for another's.

    A name right before it, or the name before the list that it stands in, comes
    with a candidate; what follows up to the next candidate's name does too."""
    last = F.size(x["tokens"]) - 1

    def one(t: Column, k: Column) -> Column:
        gap, after = F.get(x["gaps"], k), F.get(x["gaps"], k + 1)
        start = F.greatest(F.lit(1), k + 2 - LIST_BACK)
        named = F.filter(F.slice(x["gaps"], start, k + 2 - start), lambda g: g.rlike("[A-Za-z0-9]"))
        listed = F.coalesce(F.get(named, F.size(named) - 1), F.get(x["gaps"], F.lit(0)))
        name = F.get(x["tokens"], k - 1)
        left = F.when((k == 0) | gap.rlike("[A-Za-z0-9]"), gap).otherwise(F.concat(listed, gap))
        right = F.when(k == last, after).otherwise(F.regexp_extract(after, "^[^A-Za-z0-9]*", 0))
        before = (F.when(k == 0, x["b"])
                  .when(gap.rlike("^[\"'`]?[=:]"), name)
                  .when(F.size(named) > 0, "").otherwise(x["b"]))
        return F.struct(x["i"].alias("i"), t.alias("t"), F.concat(left, t, right).alias("w"),
                        before.alias("b"), F.when(k == last, x["a"]).otherwise("").alias("a"))

    return F.transform(x["tokens"], one)


def findings_column(text: Column, path: Column, model) -> Column:
    """array<struct<pos, token, score>> of a text's candidates, in order."""

    def of_words(words: Column) -> Column:
        hits = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                        lambda x: (F.length(x["w"]) >= MIN_LENGTH) & x["w"].rlike(_CANDIDATE))
        at = lambda x, k: F.coalesce(F.get(words, x["i"] + k), F.lit(""))
        # Every candidate of every word, with the word and its neighbours.
        found = F.flatten(F.transform(hits, lambda x: let(
            F.struct(x["i"].alias("i"), F.concat_ws(" ", at(x, -2), at(x, -1)).alias("b"),
                     at(x, 1).alias("a"),
                     F.regexp_extract_all(x["w"], F.lit(_CANDIDATE), F.lit(0)).alias("tokens"),
                     F.split(x["w"], _CANDIDATE).alias("gaps")), _in_word)))
        return F.transform(found, lambda c: let(
            feature_struct(c["t"], c["w"], c["b"], c["a"], path), lambda f: F.struct(
                c["i"].alias("pos"), c["t"].alias("token"),
                forest_expression(model, f).alias("score"))))

    kind = "array<struct<pos:int,token:string,score:double>>"
    return F.when(text.rlike(_CANDIDATE), let(F.split(text, r"\s+"), of_words).cast(kind)).otherwise(
        F.array().cast(kind))


def scan(df: DataFrame, model=None, id_col: str = "doc_id", text_col: str = "text",
         path_col: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, n_candidates, n_secrets, findings (pos,
    token, score)."""
    model = model or train_forest(df.sparkSession)
    path = F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    found = df.select(F.col(id_col).alias("doc_id"), findings_column(
        F.coalesce(F.col(text_col), F.lit("")), path, model).alias("findings"))
    return found.select("doc_id", F.size("findings").cast("long").alias("n_candidates"),
                        F.size(F.filter("findings", lambda x: x["score"] >= threshold))
                        .cast("long").alias("n_secrets"), "findings")


def redact(df: DataFrame, model=None, text_col: str = "text", path_col: str = "source",
           chars_col: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with every confirmed secret replaced by a mask; all rows and columns
    stay, and ``chars_col`` follows the new text. A secret is masked wherever it
    stands as a whole run of key characters, and never inside a longer one (such as
    a digest that begins like it)."""
    model = model or train_forest(df.sparkSession)
    path = F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    name = fresh(df, "secrets")
    out = df.withColumn(name, F.transform(F.filter(
        findings_column(F.coalesce(F.col(text_col), F.lit("")), path, model),
        lambda x: x["score"] >= threshold), lambda x: x["token"]))
    # Key characters have no meaning in a pattern, save for + (and - in a set).
    whole = lambda t: F.concat(F.lit("(?<![A-Za-z0-9+/_-])"), F.replace(
        t, F.lit("+"), F.lit("[+]")), F.lit("(?![A-Za-z0-9+/_-])"))
    # Longer tokens first: one may be another with its padding.
    tokens = F.reverse(F.array_sort(F.transform(F.array_distinct(name), lambda t: F.struct(
        F.length(t).alias("n"), t.alias("t")))))
    clean = F.aggregate(tokens, F.col(text_col), lambda acc, t: F.regexp_replace(
        acc, whole(t["t"]), F.lit(MASK)))
    out = out.withColumn(text_col, F.when(F.size(name) > 0, clean).otherwise(F.col(text_col)))
    if chars_col and chars_col in df.columns:
        kind = df.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.when(
            F.size(name) > 0, F.length(text_col).cast(kind)).otherwise(F.col(chars_col)))
    return out.drop(name)
