"""URL filter: rules by host and path, else logistic regression on hashed
character n-grams of host and path.

The classifier is a Spark ML pipeline (character n-grams of two lengths,
hashed term counts, logistic regression) fitted on a small labelled URL table,
which is a parameter; ``labelled_urls`` gives its default. Scoring stays in the
JVM. The default names topics (gambling, pills, adverts and so on against news,
schools and so on) and no host of a given table, so a host is judged by the
topic words in it and passes where none is known.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end; both are empty for
a null URL or one without ``://``. A rule ``host/path`` fits its host and all
subdomains when the URL's path starts with the rule's path; the longest fitting
rule decides, and of rules of equal length the first.

Defined results: a URL without host and path has no n-grams and gets the
classifier's prior verdict; rows repeat with equal verdicts; other columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The contract's rules: (host and path, verdict).
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow")]

# Words that name what unwanted and wanted sites are about, and
# words that go with either.
_UNWANTED = """casino roulette poker blackjack jackpot slots bets betting bookie bingo lottery wager gambling
pills pharmacy viagra steroids slimming diet opioid spam backlinks linkbuilding clickbait popup popunder
adserver ads adclick banner tracker tracking telemetry malware spyware phishing scam warez cracks keygen
pirate xxx porn adult escort hookup webcam loans payday debt forex replica""".split()
_WANTED = """news weather library museum university recipes garden travel science history theatre music school
hospital council wiki journal books radio forum maps archive photos kitchen cycling village orchestra botany
chess herald health sport football cinema poetry painting bakery coffee farming hiking sailing railway
airport bridge harbour island river mountain forest bird horse software database compiler physics biology
chemistry algebra geology astronomy medicine nursing law parliament election budget museo biblioteca cocina
noticias escuela montana schule garten wetter nachrichten verein rathaus kirche ecole jardin cuisine
musee mairie meteo voyage peinture""".split()
_COMPANIONS = """best my online club hub city daily world new top shop house big express royal green blue first
vip zone portal direct plus king lucky point land central super home""".split()
_PATHS = ["/en/{}", "/de/{}/", "/fr/{}.html", "/es/{}", "/articles/{}", "/"]
_PREFIXES = ["", "www.", "m.", "blog."]
_ENDS = ["example.com", "example.org", "example.net"]
_JOINS = ["{0}-{1}", "{1}-{0}", "{0}{1}", "{1}{0}"]
#: Names made of each word with companions, beside the word alone.
NAMES = 6
#: Made-up wanted names, as of firms and persons: most sites' names say no topic.
INVENTED = 400
#: URLs of each name, with different prefixes, domains and paths.
URLS = 3


def labelled_names() -> list[tuple[str, int]]:
    """(site name, 1 for block): each word alone and with ``NAMES``
    companions, and invented wanted names of consonants and vowels."""
    out = []
    for i in range(INVENTED):
        letters = [("bcdfghklmnprstvwz", "aeiou")[j % 2] for j in range(5 + i % 4)]
        out.append(("".join(a[(i * (2 * j + 3) + i // 17 * (j + 1) + j) % len(a)]
                            for j, a in enumerate(letters)), 0))
    for label, words in ((1, _UNWANTED), (0, _WANTED)):
        for i, word in enumerate(words):
            out.append((word, label))
            for j in range(NAMES):
                other = _COMPANIONS[(7 * i + 5 * j) % len(_COMPANIONS)]
                out.append((_JOINS[(i + j) % 4].format(word, other), label))
    return out


def labelled_urls(names: list[tuple[str, int]] | None = None) -> list[tuple[str, int]]:
    """The default labelled URL table: (url, 1 for block), ``URLS`` rows for
    each of about 1,400 names; prefixes, domains and paths say nothing about
    the label."""
    rows = []
    for i, (name, label) in enumerate(names if names is not None else labelled_names()):
        for k in range(i, i + 5 * URLS, 5):
            host = f"{_PREFIXES[k % 4]}{name}.{_ENDS[k % 3]}"
            rows.append((f"https://{host}{_PATHS[(k + i // 7) % 6].format(k * 37 % 10000)}", label))
    return rows


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                      F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, or null."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: -len(r[0])):
        rule_host, slash, rest = rule.partition("/")
        fits = (((host == rule_host) | host.endswith("." + rule_host))
                & path.startswith(slash + rest))
        out = F.when(fits, F.lit(rule)) if out is None else out.when(fits, F.lit(rule))
    return out if out is not None else F.lit(None).cast("string")


def _features(urls: DataFrame) -> DataFrame:
    text = F.concat(F.lit("^"), F.col("host"), F.col("path"), F.lit("$"))
    return urls.withColumn("chars", F.when((F.col("host") == "") & (F.col("path") == ""),
                                           F.array().cast("array<string>"))
                           .otherwise(F.split(F.lower(text), "(?!^)(?!$)")))


def fit(spark: SparkSession, labelled: list[tuple[str, int]] | None = None,
        lengths: tuple[int, ...] = (3, 4), buckets: int = 1 << 14) -> PipelineModel:
    rows = labelled if labelled is not None else labelled_urls()
    blocked = sum(label for _, label in rows)
    table = spark.createDataFrame(rows, "url string, label int").select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("label").cast("double").alias("label"),
        # both labels count alike, however many rows name them
        (F.lit(len(rows) / 2) / F.when(F.col("label") == 1, blocked).otherwise(len(rows) - blocked))
        .alias("weight"))
    stages = []
    for n in lengths:
        stages += [NGram(n=n, inputCol="chars", outputCol=f"grams{n}"),
                   HashingTF(numFeatures=buckets, binary=True, inputCol=f"grams{n}",
                             outputCol=f"hashed{n}")]
    stages += [VectorAssembler(inputCols=[f"hashed{n}" for n in lengths], outputCol="features"),
               LogisticRegression(regParam=0.003, standardization=False, maxIter=50, weightCol="weight")]
    return Pipeline(stages=stages).fit(_features(table).coalesce(1))


def judge(pages: DataFrame, model: PipelineModel | None = None,
          rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
          threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): ``score`` is the
    classifier's probability of block."""
    model = model or fit(pages.sparkSession)
    url = F.col(url_col).cast("string")
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"),
                        path_of(url).alias("path"))
    scored = model.transform(_features(urls))
    score = F.get(vector_to_array("probability"), F.lit(1))
    by_rule = None
    for name, verdict in rules:
        is_it = F.col("rule") == name
        by_rule = F.when(is_it, F.lit(verdict)) if by_rule is None else by_rule.when(is_it, F.lit(verdict))
    by_score = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    verdict = F.coalesce(by_rule, by_score) if by_rule is not None else by_score
    return (scored.select("page_id", "host", "path",
                          rule_of(F.col("host"), F.col("path"), rules).alias("rule"),
                          score.alias("score"))
            .select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score"))
