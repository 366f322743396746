"""URL filters: rules first, then logistic regression on hashed character n-grams.

Everything here is DataFrame functions: no Python runs on executors and no page row is shuffled.

* A url's features are the distinct buckets of the 3- and 4-grams of ``^host$`` and ``^path$``, with
  every digit as 0 (the first three hex digits of an md5, so 4096 buckets), scaled to length 1.
* The model is trained by full-batch gradient descent over a small labelled table. The steps run
  on the coefficients ``a`` of the examples, ``w = sum a_i x_i``, which is the same descent as on
  ``w``: ``a_i <- (1 - rate * decay) a_i + rate (y_i - p_i)``. The table is one row of arrays, and
  the steps are one ``aggregate`` over it.
* The fitted weights are one array of 4096 doubles, read by the scan through a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 4096
GRAMS = (3, 4)
#: Most labelled urls that a model is fitted on.
MOST_EXAMPLES = 2_000
STEPS, RATE, DECAY = 200, 0.05, 0.005
#: Rules are part of the query's expression, so their number is bounded.
MAX_RULES = 500

#: (verdict, host, path prefix)
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

#: Training urls by label (1: block).
BLOCKED_URLS = [
    "http://casino-bonus.bets.biz/win/jackpot",
    "http://free-casino.games.top/casino/slots?id=1",
    "https://poker-online.win/bonus/poker-chips",
    "http://best-slots.casino/slots/free-spins",
    "http://xxx-cams.adult.top/xxx/live",
    "http://hot-porn.videos.xxx/porn/free",
    "https://adult-dating.click/adult/singles",
    "http://sexy-girls.cam/sex/chat",
    "http://cheap-viagra.pills.shop/viagra/buy-now",
    "http://pills-online.pharmacy.top/cialis/cheap",
    "http://replica-watches.shop/replica/rolex-cheap",
    "http://payday-loan.click/loan/instant-cash",
    "http://crypto-doubler.win/bitcoin/double-now",
    "http://free-bitcoin.top/bitcoin/bonus",
    "http://cracked-software.download/crack/keygen.exe",
    "http://warez.torrents.top/torrent/crack",
    "http://ads.doubletrack.biz/adclick/banner",
    "http://popads.clicks.top/ads/pop?c=2",
    "http://tracker.adserver.click/track/pixel",
    "http://lottery-winner.win/claim/prize",
    "http://login-verify.account.top/signin/verify-account.php",
    "http://secure-bank.verify.click/login/password-reset.php",
    "http://weightloss-miracle.shop/miracle/pills",
    "http://escort-girls.top/escort/adult",
]
ALLOWED_URLS = [
    "https://en.encyclopedia.example.org/wiki/Spark",
    "https://www.library.example.org/en/books/12",
    "http://blog.example.com/en/853/",
    "http://www.example.com/fr/825?page=2",
    "https://m.example.org/en/25#top",
    "http://news.example.com/es/190",
    "https://docs.example.org/3/library/functions.html",
    "https://www.university.edu/research/papers/2020",
    "https://physics.university.edu/courses/101",
    "https://news.daily.com/2021/05/12/story",
    "https://www.daily.com/world/europe/article",
    "https://museum.city.gov/collection/paintings",
    "https://www.health.gov/topics/nutrition",
    "https://data.city.gov/dataset/transport",
    "https://recipes.kitchen.com/soup/tomato",
    "https://www.garden.org/plants/roses",
    "https://travel.guide.com/italy/rome",
    "https://forum.linux.org/thread/4711",
    "https://www.history.org/articles/rome",
    "https://math.school.edu/algebra/lesson-3",
    "https://code.project.io/docs/getting-started",
    "https://api.project.io/reference/v2",
    "https://shop.books.com/novels/classics",
    "https://www.music.org/scores/bach",
    "https://weather.service.gov/forecast/today",
    "https://science.magazine.com/biology/cells",
    "https://www.law.edu/cases/1999",
    "https://en.dictionary.com/define/word",
    "https://blog.engineer.io/posts/2019/streams",
    "https://www.birds.org/species/owl",
    "https://maps.city.gov/streets",
    "https://www.chess.org/openings/e4",
    "https://radio.station.com/program/morning",
    "https://www.film.org/reviews/drama",
    "https://wiki.example.net/en/page",
    "https://stories.example.com/en/676",
    "https://archive.example.org/de/44",
    "https://www.hospital.org/departments/surgery",
    "https://jobs.company.com/openings/engineer",
    "https://support.company.com/help/article/9",
]
#: Host labels on ordinary domains, where the label alone tells the class.
BLOCKED_LABELS = (
    "online-casino casino-royal casino-games win-casino big-win sport-bets bets-today free-spins ads-server "
    "banner-ads click-track track-user web-track pixel-track spam-mail spam-links link-farm content-farm diet-pills "
    "buy-pills cheap-meds cheap-shop adult-chat adult-video adult-cams xxx-free free-money free-prize win-prize "
    "hot-sex x-rated payday-cash"
)
ALLOWED_LABELS = (
    "therein station garden nation reading shore heron thunder island hand-made well-read other weather mother river "
    "northern southern teaching learning nature culture forest mountain history science ocean winter summer kitchen "
    "travel painting evening morning orchestra theatre literature astronomy geometry engineer harvest heritage "
    "another earth hearing thread thing within leather feather stone thorn onion bread season reason motion region"
)


def placed(labels: str) -> list[str]:
    """Urls of these host labels, taking turns at sub-domains, domains and paths."""
    subs, ends, langs = ("", "www.", "m.", "blog."), ("com", "org", "net"), ("en", "fr", "de", "es", "en")
    return [
        f"http://{subs[i % 4]}{w}.example.{ends[i % 3]}/{langs[i % 5]}/{17 * i + 3}{('', '/', '.html')[i // 2 % 3]}"
        for i, w in enumerate(labels.split())
    ]


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    known = url.isNotNull() & (at > 0)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def best_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(size, rule, verdict) of the longest rule that fits, or null; ties between rules of
    one length go to the greater text."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} can be part of one expression")
    fits = []
    for verdict, rule_host, rule_path in rules:
        ok = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = rule_host + rule_path
        fits.append(F.when(ok, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, however often lambdas in it use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def buckets(host: Column, path: Column) -> Column:
    """The distinct feature buckets of a url."""
    def grams(mark: str, letters: Column, n: int) -> Column:
        starts = F.when(F.size(letters) >= n, F.sequence(F.lit(1), F.size(letters) - n + 1))

        def bucket(i: Column) -> Column:
            gram = F.concat(F.lit(f"{mark}{n}"), F.array_join(F.slice(letters, i, F.lit(n)), ""))
            return F.conv(F.substring(F.md5(gram.cast("binary")), 1, 3), 16, 10).cast("int")

        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), bucket)

    found = []
    for mark, text in (("h", host), ("p", path)):
        text = F.translate(text, "123456789", "000000000")
        letters = F.filter(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), lambda c: c != "")
        found += [let(letters, lambda v: grams(mark, v, n)) for n in GRAMS]  # noqa: B023 (called at once)
    return F.array_distinct(F.concat(*found))


def coefficients(examples: DataFrame) -> DataFrame:
    """``y, g, a``: labelled urls' buckets and their fitted coefficients.

    ``examples`` has ``url, label``. It becomes one row and a kernel of its length squared, so a
    table of more than ``MOST_EXAMPLES`` rows raises. A table without one of the labels gives
    that label no support; an empty one leaves every page to the bias.
    """
    if examples.limit(MOST_EXAMPLES + 1).count() > MOST_EXAMPLES:
        raise ValueError(f"more than {MOST_EXAMPLES} labelled urls: the model is fitted on a small table")
    host, path = parts(F.col("url"))
    rows = examples.where(F.col("label").isin(0, 1)).select("url", F.col("label").cast("double").alias("y"), buckets(host, path).alias("g"))
    rows = rows.where(F.size("g") > 0)
    one = rows.agg(F.array_sort(F.collect_list(F.struct("url", "y", "g"))).alias("e"))
    kernel = F.transform(
        "e",
        lambda r: F.transform("e", lambda c: 1 + F.size(F.array_intersect(r["g"], c["g"])) / F.sqrt(F.size(r["g"]) * F.size(c["g"]))),
    )

    def descend(data: Column) -> Column:
        def step(a: Column, _: Column) -> Column:
            def updated(ai: Column, i: Column) -> Column:
                products = F.zip_with(a, F.get(data["k"], i), lambda x, y: x * y)
                z = F.aggregate(products, F.lit(0.0), lambda s, v: s + v)
                return ai * (1 - RATE * DECAY) + RATE * (F.get(data["y"], i) - 1 / (1 + F.exp(-z)))

            return F.transform(a, updated)

        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.transform(data["y"], lambda y: F.lit(0.0)), step)

    data = F.struct(F.transform("e", lambda r: r["y"]).alias("y"), kernel.alias("k"))
    fitted = one.select("e", let(data, descend).alias("a"))
    pairs = fitted.select(F.explode(F.arrays_zip("e", "a")).alias("x"))
    return pairs.select("x.e.y", "x.e.g", "x.a")


def weights(examples: DataFrame) -> DataFrame:
    """One row: ``w``, the weight of every bucket, and ``bias``. Without examples all are 0."""
    spark = examples.sparkSession
    fitted = coefficients(examples)
    summed = fitted.select(F.explode("g").alias("bucket"), (F.col("a") / F.sqrt(F.size("g"))).alias("w"))
    summed = summed.groupBy("bucket").agg(F.sum("w").alias("w"))
    every = spark.range(BUCKETS).join(summed, F.col("id") == F.col("bucket"), "left")  # BUCKETS rows
    array = every.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("w", F.lit(0.0)).alias("w")))).alias("x"))
    bias = fitted.agg(F.coalesce(F.sum("a"), F.lit(0.0)))
    return array.select(F.struct(F.transform("x", lambda p: p["w"]).alias("w"), bias.scalar().alias("bias")).alias("model"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The training table of this module."""
    quote = lambda u, y: f"('{u}', {y})"
    rows = [quote(u, 1) for u in BLOCKED_URLS + placed(BLOCKED_LABELS)]
    rows += [quote(u, 0) for u in ALLOWED_URLS + placed(ALLOWED_LABELS)]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS urls(url, label)")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, examples: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page.

    ``verdict`` is the longest fitting rule's, else ``block`` where the score is 0.5 or more.
    A null url, or one without ``://``, has empty host and path, fits no rule and is scored like
    any other. Repeated rows are judged each. Other columns are not carried.
    """
    model = weights(labelled_urls(pages.sparkSession) if examples is None else examples)
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.select("*", best_rule(F.col("host"), F.col("path"), rules).alias("best"), model.scalar().alias("model"))

    def logit(g: Column) -> Column:
        total = F.aggregate(g, F.lit(0.0), lambda s, b: s + F.get(F.col("model.w"), b))
        return F.col("model.bias") + total / F.sqrt(F.greatest(F.size(g), F.lit(1)))

    z = let(buckets(F.col("host"), F.col("path")), logit)
    rows = rows.select("page_id", "host", "path", "best", (1 / (1 + F.exp(-z))).alias("score"))
    by_model = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", by_model).alias("verdict"), "score")


def op6_url_filters(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Judge every page's url by RULES and the model; the contract's columns."""
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")
