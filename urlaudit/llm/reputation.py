"""URL filter: explicit rules first, then the reputation of the host, shrunk from host to registered domain to suffix.

Labelled pages are counted for each host as bad or not. The rate of bad pages of a host has a beta prior around the rate of its
registered domain, that one around the rate of its suffix, and that one around the rate of all. How strong each prior is comes from
the table itself: the overdispersion of the children's rates around their parent's, by moments of the beta-binomial distribution. A
host is blocked if the lower bound of its posterior rate exceeds a cutoff, so a few bad pages condemn no host, and a host without labels is
judged by those above it. The bound is that of the normal approximation after the variance-stabilising transform of a rate.

Rules are a policy list, part of the plan as the few literals they are. A rule fits its host and all subdomains if the path starts with
the rule's; the longest rule wins, ``block`` before ``allow`` where the same rule is in both.

Labels of pages come from labelled documents whose lines they show: a page is labelled if it has a block of at least ``LINE_WORDS``
words that is a line of a labelled document, and bad if most of the documents behind its blocks are. Lines travel as 64-bit hashes, a
labelled line is one row whatever the number of its documents, so a line of a third of all pages meets one row; hosts, domains and
suffixes are counted before they are shuffled.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and is judged by the rate of all. An empty host
has an empty domain and suffix; so does one label, or a number address, have no suffix, and is its own domain. Null or empty html or text has no lines. Rows equal in
id, URL and html are one labelled page and are judged each; an empty table gives an empty result, and without labels all that no
rule blocks is allowed. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import ascii_lower, table
from urlaudit.session import materialize

RULES = ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")
CUTOFF = 0.5  # the rate of bad pages that is not tolerated
NORMAL = 1.645  # one-sided 95 percent
LINE_WORDS = 8  # shorter lines say little about where a text comes from
LEAST_SPREAD, MOST_SPREAD, USUAL_SPREAD = 0.001, 0.5, 0.1  # bounds of the overdispersion, and what is taken if nothing tells
#: Public suffixes of two labels that are told from registered domains.
TWO_LABELS = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "co.nz", "co.za", "com.br", "co.in", "com.cn", "co.kr")
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}
WHITE = r"[\x20\x09-\x0D]+"


def with_place(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` and ``path`` of the URL."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return pages.withColumns({"host": ascii_lower(F.regexp_extract(url, parts, 1)), "path": F.regexp_extract(url, parts, 2)})


def with_owner(hosts: DataFrame) -> DataFrame:
    """Add ``domain``, the registered domain of the host, and ``suffix``; a port and a user's name belong to neither."""
    name = F.regexp_replace(F.regexp_replace("host", r"^.*@", ""), r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - (n - 1), F.lit(1)), n), ".")
    alone = (F.size(labels) < 2) | name.rlike(r"^[0-9.]+$")
    suffix = F.when(alone, "").when(last(2).isin(*TWO_LABELS), last(2)).otherwise(last(1))
    domain = F.when(alone, name).when(last(2).isin(*TWO_LABELS), last(3)).otherwise(last(2))
    return hosts.withColumns({"domain": domain, "suffix": suffix})


def rule_that_fits(rules: tuple[str, ...]) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and what it says; NULL where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for entry in sorted(rules, key=lambda e: (len(e.split(" ", 1)[1]), e.startswith("block"))):
        says, what = entry.split(" ", 1)
        host, slash, path = what.partition("/")
        fits = (F.col("host") == host.lower()) | F.col("host").endswith(f".{host.lower()}")
        fits = fits & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, what).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _line_hashes(lines: Column) -> Column:
    """Hashes of the distinct lines with enough words, white space as one space."""
    spaced = F.transform(lines, lambda line: F.trim(F.regexp_replace(line, WHITE, " ")))
    enough = F.filter(spaced, lambda line: F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) >= LINE_WORDS - 1)
    return F.array_distinct(F.transform(enough, lambda line: F.xxhash64(line)))


def _blocks(html: Column) -> Column:
    """What stands between two tags, with the usual character references decoded."""
    found = F.regexp_extract_all(html, F.lit(r">([^<]+)"), F.lit(1))

    def decoded(text: Column) -> Column:
        for entity, character in ENTITIES.items():
            text = F.replace(text, F.lit(entity), F.lit(character))
        return text

    return F.transform(found, decoded)


def page_outcomes(pages: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``url`` and ``bad`` of the pages that show lines of labelled documents."""
    bad = F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")
    judged = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(bad).where("bad IS NOT NULL")
    texts = documents.select("doc_id", _line_hashes(F.split("text", "\n")).alias("lines")).where("size(lines) > 0")
    known = texts.join(judged, "doc_id").select("bad", F.explode("lines").alias("line"))
    known = known.groupBy("line").agg(F.sum("bad").alias("bad"), F.count("*").alias("n"))
    shown = pages.select("page_id", "url", F.xxhash64("html").alias("page"), _line_hashes(_blocks(F.col("html"))).alias("lines"))
    shown = shown.select("page_id", "url", "page", F.explode("lines").alias("line")).join(known, "line")
    each = shown.groupBy("page_id", "url", "page").agg((2 * F.sum("bad") > F.sum("n")).cast("int").alias("bad"))
    return each.select("url", "bad")


def _pooled(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _spread(children: DataFrame, parents: DataFrame, key: str | None) -> float:
    """Overdispersion of the children's rates around their parent's: 0 if they differ by chance alone, 1 if each is all or nothing."""
    above = parents.where("n > 0").withColumnsRenamed({"n": "all_n", "bad": "all_bad"})
    # Without a key there is one parent, a row of sums, and its numbers go into the plan.
    if key is None:
        row = above.first()
        if row is None:
            return USUAL_SPREAD
        both = children.withColumns({"all_n": F.lit(row["all_n"]), "all_bad": F.lit(row["all_bad"])})
    else:
        both = children.join(above.select(key, "all_n", "all_bad"), key)
    m, p = F.col("all_bad") / F.col("all_n"), F.col("bad") / F.col("n")
    free = m * (1 - m) * (1 - F.col("n") / F.col("all_n"))
    sums = both.where("n > 0").agg(
        F.sum(F.col("n") * (p - m) * (p - m)).alias("seen"), F.sum(free).alias("chance"), F.sum(free * (F.col("n") - 1)).alias("room")
    )
    row = sums.first()
    if not row["room"]:
        return USUAL_SPREAD
    return min(max((row["seen"] - row["chance"]) / row["room"], LEAST_SPREAD), MOST_SPREAD)


@dataclass
class Reputation:
    """``hosts`` has ``host``, labelled and bad pages, and ``bound``, ``spread`` the overdispersion of suffixes, domains and hosts."""

    hosts: DataFrame
    spread: tuple[float, float, float]


def fit(hosts: DataFrame, outcomes: DataFrame) -> Reputation:
    """The posterior bound of every host in ``hosts``, learned from ``host`` and ``bad`` of labelled pages."""
    zero = F.lit(0).cast("long")
    rows = hosts.select("host", zero.alias("n"), zero.alias("bad")).unionByName(
        outcomes.select("host", F.lit(1).cast("long").alias("n"), F.col("bad").cast("long").alias("bad"))
    )
    counted = materialize(with_owner(_pooled(rows, "host")), "hosts")
    domains = materialize(_pooled(counted, "domain", "suffix"), "domains")
    suffixes = materialize(_pooled(domains, "suffix"), "suffixes")
    whole = _pooled(suffixes)
    spread = (_spread(suffixes, whole, None), _spread(domains, suffixes, "suffix"), _spread(counted, domains, "domain"))
    of_suffix, of_domain, of_host = ((1 - s) / s for s in spread)
    total = whole.first()
    rate = ((total["bad"] or 0) + 1.0) / ((total["n"] or 0) + 2.0)
    by_suffix = suffixes.select("suffix", ((F.col("bad") + of_suffix * rate) / (F.col("n") + of_suffix)).alias("above"))
    by_domain = domains.join(by_suffix, "suffix").select(
        "domain", ((F.col("bad") + of_domain * F.col("above")) / (F.col("n") + of_domain)).alias("above")
    )
    size = F.col("n") + of_host
    mean = (F.col("bad") + of_host * F.col("above")) / size
    angle = F.greatest(F.asin(F.sqrt(mean)) - NORMAL / (2 * F.sqrt(size + 1)), F.lit(0.0))
    judged = counted.join(by_domain, "domain").select("host", F.col("n").alias("host_pages"), F.col("bad").alias("host_bad"), F.pow(F.sin(angle), 2).alias("bound"))
    return Reputation(judged, spread)


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[str, ...] = RULES, cutoff: float = CUTOFF, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``verdict``, and of the host ``host_pages`` and ``host_bad``, its labelled pages and the bad ones.

    ``outcomes`` has the URL of each labelled page and ``bad``, 0 or 1."""
    placed = with_place(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")), "_url").drop("_url")
    labelled = with_place(outcomes.select(F.col(url_col).alias("_url"), "bad"), "_url")
    reputation = fit(placed, labelled.where("bad IS NOT NULL"))
    rule, says = rule_that_fits(rules)
    own = F.when(F.col("bound") > cutoff, "block").otherwise("allow")
    joined = placed.join(reputation.hosts, "host", "left")
    return joined.select(F.col("_id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict"), "host_pages", "host_bad")


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op11: every page's URL, judged by the rules and by what labelled documents say about its host."""
    pages, documents, labels = (table(spark, sf_dir, name) for name in ("pages", "documents", "labels"))
    return judge(pages, page_outcomes(pages, documents, labels))


ORACLE = r"""
WITH placed AS (
  SELECT page_id, url, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), judged AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), doc_lines AS (
  SELECT doc_id, list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))),
    lambda x: length(x) - length(replace(x, ' ', '')) >= 7)) AS lines
  FROM documents WHERE text IS NOT NULL
), known AS (
  SELECT line, sum(bad) AS bad, count(*) AS n FROM (SELECT bad, unnest(lines) AS line FROM doc_lines JOIN judged USING (doc_id)) GROUP BY line
), page_lines AS (
  SELECT DISTINCT page_id, url, html, unnest(list_distinct(list_filter(list_transform(regexp_extract_all(html, '>([^<]+)', 1),
    lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
      '[\x20\x09-\x0D]+', ' ', 'g'))),
    lambda x: length(x) - length(replace(x, ' ', '')) >= 7))) AS line
  FROM pages
), outcomes AS (
  SELECT page_id, url, html, CASE WHEN 2 * sum(bad) > sum(n) THEN 1 ELSE 0 END AS bad FROM page_lines JOIN known USING (line) GROUP BY page_id, url, html
), hosts AS (
  SELECT host, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS labels
  FROM (SELECT host, 0 AS n, 0 AS bad FROM placed
        UNION ALL SELECT host, 1, bad FROM outcomes JOIN (SELECT DISTINCT url, host FROM placed) USING (url)) GROUP BY host
), owned AS (
  SELECT host, n, bad, CASE WHEN alone THEN array_to_string(labels, '.') WHEN two THEN array_to_string(labels[-3:], '.') ELSE array_to_string(labels[-2:], '.') END AS domain,
    CASE WHEN alone THEN '' WHEN two THEN array_to_string(labels[-2:], '.') ELSE labels[-1] END AS suffix
  FROM (SELECT *, len(labels) < 2 OR regexp_matches(array_to_string(labels, '.'), '^[0-9.]+$') AS alone, array_to_string(labels[-2:], '.') IN
    ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'net.au', 'co.jp', 'co.nz', 'co.za', 'com.br', 'co.in', 'com.cn', 'co.kr') AS two FROM hosts)
), domains AS (
  SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM owned GROUP BY domain, suffix
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix
), whole AS (
  SELECT coalesce(sum(n), 0) AS n, coalesce(sum(bad), 0) AS bad FROM suffixes
), pairs AS (
  SELECT 1 AS level, c.n, c.bad, p.n AS all_n, p.bad AS all_bad FROM suffixes c, whole p
  UNION ALL SELECT 2, c.n, c.bad, p.n, p.bad FROM domains c JOIN suffixes p USING (suffix)
  UNION ALL SELECT 3, c.n, c.bad, p.n, p.bad FROM owned c JOIN domains p USING (domain)
), sums AS (
  SELECT level, sum(n * (bad / n - all_bad / all_n) ** 2) AS seen, sum(all_bad / all_n * (1 - all_bad / all_n) * (1 - n / all_n)) AS chance,
    sum(all_bad / all_n * (1 - all_bad / all_n) * (1 - n / all_n) * (n - 1)) AS room
  FROM pairs WHERE n > 0 GROUP BY level
), strength AS (
  SELECT l.level, (1 - s) / s AS k FROM (SELECT unnest([1, 2, 3]) AS level) l LEFT JOIN sums USING (level),
    LATERAL (SELECT CASE WHEN coalesce(room, 0) = 0 THEN 0.1::DOUBLE ELSE least(greatest((seen - chance) / room, 0.001), 0.5) END AS s)
), by_suffix AS (
  SELECT suffix, (bad + k * (SELECT (bad + 1.0) / (n + 2.0) FROM whole)) / (n + k) AS above FROM suffixes, strength WHERE level = 1
), by_domain AS (
  SELECT domain, (bad + k * above) / (n + k) AS above FROM domains JOIN by_suffix USING (suffix), strength WHERE level = 2
), bounds AS (
  SELECT host, n, bad, sin(greatest(asin(sqrt((bad + k * above) / (n + k))) - 1.645 / (2 * sqrt(n + k + 1)), 0)) ** 2 AS bound
  FROM owned JOIN by_domain USING (domain), strength WHERE level = 3
), ruled AS (
  SELECT *, CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM placed
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict, n AS host_pages, bad AS host_bad
FROM ruled LEFT JOIN bounds USING (host)
"""
