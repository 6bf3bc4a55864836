"""Secret scan with false-positive removal by a random forest, in DataFrame functions and the JVM's own forest only.

Candidates are private key headers, unbroken runs of 16 or more key-like characters with a digit, and values of any six or
more characters after an assignment or a cue word; the name before an equals sign is not part of them. The forest judges each
by its length, its character transitions, how much of it dictionary words cover, the path it was found at and the words
beside it. It is trained from labelled findings: ``training_findings`` writes a bounded set of them from a seed, and a
table of reviewed findings of the same columns can be given instead.

Candidates are cut out within their own row; only their narrow rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastra.llm.common import SPACE, staged, table

CUES = ("token", "secret", "password", "passwd", "pwd", "key", "auth", "bearer", "credential", "credentials", "signature")
_RUN = "A-Za-z0-9+/_-"
#: What ends a value that stands without quotes; such a value does not end with a full stop or colon.
_STOP = SPACE + r"\"'`<>,;&|(){}\[\]"
_CUED = "|".join(f"(?<={c}[ :])|(?<={c}: )" for c in CUES)
CANDIDATE = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
    rf"|(?<![{_RUN}])(?=[A-Za-z+/_-]*[0-9])[{_RUN}]{{16,}}={{0,2}}(?!=*[{_RUN}])"
    rf"|(?:(?<=[=:][\"'])|(?<=[=:] [\"']))[^{SPACE}\"']{{6,}}(?=[\"'])"
    rf"|(?:(?<==)|(?<== )|(?<=[ :])(?i:{_CUED}))(?!=)[^{_STOP}]{{5,}}[^{_STOP}.:]"
)
#: Characters kept on either side of a candidate for the words beside it.
BESIDE = 60
MAX_FINDINGS = 6000
TREES, DEPTH, THRESHOLD = 40, 8, 0.5
SECRET_WORDS = "token|secret|passw|pwd|api|apikey|key|auth|bearer|credential|private|signature"
PLAIN_WORDS = "commit|sha|sha1|sha256|md5|hash|checksum|digest|uuid|guid|etag|integrity|card|phone|number|isbn|order|build|version|file|page"
DICTIONARY = (
    "test|example|sample|release|version|build|name|value|user|data|file|image|page|index|report|content|module|package|"
    "config|default|service|server|client|table|column|number|order|street|update|final|draft|document|backup|static|public|"
    "layer|model|train|valid|batch|alpha|beta|stable|windows|linux|jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec|"
    "the|and|ing|tion|ment|http|www|html|json|xml|com|org|net|src|lib|app"
)
FEATURES = (
    "length", "digits", "uppers", "lowers", "others", "turns", "vowel_turns", "distinct", "dictionary", "hex", "all_digits",
    "parts", "longest_run", "secret_before", "plain_before", "assigned", "quoted", "words_before", "path_test", "path_code",
)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(row, doc_id, path, start, end, candidate, before, after); a document without candidates has one row of nulls.

    row numbers the input rows within this result, so repeated rows stay apart. Offsets are code points, the end
    exclusive.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col and path_col in docs.columns else F.lit("")
    cut = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), path.alias("path"),
        F.when(text.rlike(CANDIDATE), text).alias("text"),
    ).select(
        "row", "doc_id", "path", F.split("text", CANDIDATE, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(CANDIDATE), 0).alias("hits")
    )
    around = F.transform(F.col("gaps"), lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(BESIDE)).alias("before"), F.left(g, F.lit(BESIDE)).alias("after")))
    listed = cut.select("row", "doc_id", "path", "hits", around.alias("gaps")).select(
        "row", "doc_id", "path",
        F.posexplode_outer(F.transform("hits", lambda h, i: F.struct(
            h.alias("candidate"), F.get("gaps", i)["n"].alias("gap"), F.get("gaps", i)["before"].alias("before"),
            F.get("gaps", i + 1)["after"].alias("after"),
        ))).alias("i", "x"),
    ).select("row", "doc_id", "path", "i", "x.*")
    run = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("candidate")).over(run)
    return listed.withColumn("end", end.cast("long")).select(
        "row", "doc_id", "path", (F.col("end") - F.length("candidate")).alias("start"), "end", "candidate", "before", "after"
    )


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.greatest(F.length("candidate"), F.lit(1))


def with_features(found: DataFrame) -> DataFrame:
    """found(candidate, before, after, path, ...) plus a double column f_<name> for each of FEATURES; nulls give zeros."""
    low = F.lower("candidate")
    near = F.lower(F.right(F.col("before"), F.lit(30)))
    chars = F.filter(F.split("candidate", ""), lambda c: c != F.lit(""))
    flag = lambda c: c.cast("double")
    made = {
        "length": F.length("candidate"), "digits": _share("[0-9]"), "uppers": _share("[A-Z]"), "lowers": _share("[a-z]"),
        "others": _share("[^A-Za-z0-9]"),
        "turns": _share("(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"),
        "vowel_turns": _share("(?i)(?<=[aeiou])(?=[bcdfghjklmnpqrstvwxyz])|(?<=[bcdfghjklmnpqrstvwxyz])(?=[aeiou])"),
        "distinct": F.size(F.array_distinct(chars)) / F.greatest(F.length("candidate"), F.lit(1)),
        "dictionary": 1 - F.length(F.regexp_replace(low, DICTIONARY, "")) / F.greatest(F.length("candidate"), F.lit(1)),
        "hex": flag(F.col("candidate").rlike("^[0-9a-f]+$")), "all_digits": flag(F.col("candidate").rlike("^[0-9_/=+-]+$")),
        "parts": F.size(F.split("candidate", "[_/=+-]+")),
        "longest_run": F.array_max(F.transform(F.split("candidate", "[^a-z]+"), F.length)),
        "secret_before": flag(near.rlike(SECRET_WORDS)), "plain_before": flag(near.rlike(f"(^|[^a-z])({PLAIN_WORDS})[^a-z]")),
        "assigned": flag(near.rlike(r"[=:]\s*[\"']?$")), "quoted": flag(F.col("after").rlike("^[\"']")),
        "words_before": F.size(F.split(F.trim(near), r"\s+")),
        "path_test": flag(F.lower("path").rlike("test|example|sample|fixture|mock|doc")),
        "path_code": flag(F.lower("path").rlike(r"\.(py|js|ts|java|go|rb|env|ya?ml|json|toml|ini|cfg|conf|properties)$")),
    }
    return found.withColumns({f"f_{k}": F.coalesce(made[k].cast("double"), F.lit(0.0)) for k in FEATURES})


def training_findings(spark: SparkSession, n: int = MAX_FINDINGS, seed: int = 17) -> DataFrame:
    """n labelled findings (candidate, before, after, path, label): keys, tokens and passwords, and what resembles them."""
    h = lambda k: F.sha2(F.concat_ws(":", F.lit(seed), F.lit(k), "id"), 512)
    bits = lambda k, m: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "id"), F.lit(m))
    pick = lambda k, xs: F.element_at(F.array(*[F.lit(x) if isinstance(x, str) else x for x in xs]), (bits(k, len(xs)) + 1).cast("int"))
    b64 = lambda k, size: F.substring(F.regexp_replace(F.base64(F.unhex(h(k))), "[\r\n]", ""), 1, size)
    digits = lambda k, size: F.substring(F.translate(h(k), "abcdef", "184620"), 1, size)
    words = "the of and street order page was on by data la de der ein que".split()
    word = lambda k: F.concat(pick(k, words), pick(k + 50, words), pick(k + 90, words))
    hexes = lambda k: F.substring(h(k), 1, 20)
    letters = lambda k, size: F.translate(b64(k, size), "+/0123456789=", "qzKxWvJhTbGpd")
    common = (
        "required optional provider management exchange rotation available generated expired validation somewhere together language "
        "children question elephant mountain internal external undefined placeholder changed following between without because "
        "sprache zwischen schule maison toujours quelque ciudad nombre tiempo welcome summary default production development"
    ).split()
    secret = pick(1, [
        F.substring(h(2), 1, 40), F.substring(h(2), 1, 32), b64(3, 40), b64(3, 32), F.concat(F.lit("AKIA"), F.upper(F.substring(h(4), 1, 16))),
        F.concat(F.lit("ghp_"), F.translate(b64(5, 36), "+/", "aZ")), F.concat(F.lit("sk-"), F.translate(b64(6, 44), "+/", "bY")),
        F.substring(h(7), 1, 64), F.translate(b64(8, 24), "+/", "_-"), F.concat(F.lit("xoxb-"), digits(9, 12), F.lit("-"), F.translate(b64(10, 24), "+/", "cX")),
        F.lit("-----BEGIN RSA PRIVATE KEY-----"), F.lit("-----BEGIN PRIVATE KEY-----"),
        F.translate(b64(60, 12), "+/", "!#"), F.translate(b64(61, 9), "+/=", "$@x"), letters(62, 20), letters(63, 12),
        F.concat(pick(64, ["P@ss", "Adm!n", "S3cr#t", "Qw*rt", "L0gin%"]), pick(65, list("!#$%*?@^")), b64(66, 6), digits(67, 3), pick(68, list("!#$%*?@^"))),
        F.concat(F.translate(b64(69, 8), "+/", "k7"), pick(70, list("!#$%*?@^")), F.translate(b64(71, 8), "+/", "m3")),
    ])
    plain = pick(11, [
        digits(12, 16), F.substring(h(13), 1, 40), F.substring(h(13), 1, 64), F.substring(h(13), 1, 32),
        F.concat_ws("-", F.substring(h(14), 1, 8), F.substring(h(14), 9, 4), F.substring(h(14), 13, 4), F.substring(h(14), 17, 4), F.substring(h(14), 21, 12)),
        F.concat_ws("_", word(15), word(16), digits(17, 2)), F.concat_ws("-", F.lit("release"), digits(18, 4), word(19), digits(20, 2)),
        F.concat_ws("/", F.lit("static"), word(21), word(22), digits(23, 3)), F.concat(word(24), word(25), digits(26, 1)),
        F.concat_ws("-", digits(27, 4), digits(28, 2), digits(29, 5), digits(30, 5)), F.concat(digits(31, 13), F.lit("="), digits(32, 3)),
        F.concat(F.repeat(F.lit("a"), 12), F.repeat(F.lit("1"), 12)),
        pick(72, common), F.concat(pick(74, common), pick(73, ["", "_", "-", "."]), pick(75, common)), digits(76, 8),
        F.concat(F.lit("https://www."), pick(77, common), F.lit(".org/"), pick(78, common)), F.concat(F.lit("${"), F.upper(pick(79, common)), F.lit("}")),
        F.concat(pick(80, common), F.lit("."), pick(81, ["py", "json", "html", "txt"])), F.concat(F.lit("./"), pick(82, common), F.lit("/"), pick(83, common)),
    ])
    hash_like = F.col("candidate").rlike("^[0-9a-f]{32,64}$|^[0-9a-f]{8}-")
    lead = F.concat_ws(" ", pick(33, words), pick(34, words))
    secret_cue = F.concat(lead, F.lit(" "), pick(35, ["token", "api_key", "secret", "password", "AUTH_TOKEN", "private key", "Bearer", "client_secret", "apikey"]), pick(36, [' = "', "=", ": ", ' "', "='", " "]))
    plain_cue = F.concat(lead, F.lit(" "), pick(37, ["commit", "sha256", "md5", "checksum", "uuid", "file", "version", "build", "etag", "order"]), pick(38, [" ", ": ", "=", ' "']))
    free = F.concat(lead, F.lit(" "))
    base = spark.range(n, numPartitions=4).withColumn("label", (bits(40, 2) == 0).cast("double"))
    made = base.withColumn("candidate", F.when(F.col("label") == 1, secret).otherwise(plain))
    strong = F.col("candidate").rlike("^(AKIA|ghp_|sk-|xoxb-|-----)")
    before = (
        F.when((F.col("label") == 1) & strong & (bits(41, 3) == 0), free).when(F.col("label") == 1, secret_cue)
        .when(hash_like & (bits(42, 3) > 0), plain_cue).otherwise(F.when(bits(43, 4) == 0, plain_cue).otherwise(free))
    )
    dull = F.col("candidate").rlike(r"^[a-z]+([_.-]?[a-z]+)*$|^[0-9]{8}$|^https:|^[$]|^[.]/")
    before = F.when((F.col("label") == 0) & dull & (bits(47, 3) > 0), secret_cue).otherwise(before)
    path = pick(44, ["", "", "src1", "src7", "app/settings.py", "config/prod.env", "tests/fixtures/data.json", "docs/example.md", "package-lock.json"])
    return made.select("candidate", before.alias("before"), F.concat(pick(45, ['"', "'", " ", ".", ","]), hexes(46)).alias("after"), path.alias("path"), "label")


def train(findings: DataFrame, seed: int = 17, limit: int = MAX_FINDINGS):
    """A forest of labelled findings (candidate, before, after, path, label 0 or 1), of at most ``limit`` of them."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    some = findings.where("label IS NOT NULL").orderBy(F.xxhash64(F.lit(seed), "candidate", "before"), "candidate").limit(limit)
    gather = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features")
    rows = gather.transform(with_features(some)).select("features", F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, subsamplingRate=0.8)
    return gather, forest.fit(staged(rows.coalesce(2), "findings"))


def scan(found: DataFrame, model) -> DataFrame:
    """found (of ``candidates``) plus probability and secret; rows without a candidate have nulls there."""
    from pyspark.ml.functions import vector_to_array

    gather, forest = model
    judged = forest.transform(gather.transform(with_features(found)))
    chance = F.when(F.col("candidate").isNotNull(), F.get(vector_to_array("probability"), F.lit(1)))
    out = judged.withColumn("__p", chance).select(*found.columns, F.col("__p").alias("probability"))
    return out.withColumn("secret", F.col("probability") >= THRESHOLD)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", model=None) -> DataFrame:
    """(doc_id, n_candidates, n_secrets, secrets): secrets lists start:end of what the forest keeps, in order.

    One row per input row; null texts count as empty and give zeros and an empty list; null paths count as empty. An
    empty table gives an empty result; other columns are ignored.
    """
    model = train(training_findings(docs.sparkSession)) if model is None else model
    found = scan(candidates(docs, id_col, text_col, path_col), model)
    span = F.when(F.col("secret"), F.struct("start", "end"))
    per = found.groupBy("row", "doc_id").agg(
        F.count("candidate").alias("n_candidates"), F.count_if("secret").alias("n_secrets"), F.array_sort(F.collect_list(span)).alias("spans")
    )
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return per.select("doc_id", "n_candidates", "n_secrets", listed.alias("secrets"))


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
