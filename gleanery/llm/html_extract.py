"""HTML extraction: host suffix array.

A page is parsed into blocks of text. The token streams of a host's pages, whatever they hold, are put together in a suffix array
with common prefixes, and runs of MIN_RUN tokens or more that recur on MIN_PAGES distinct pages are boilerplate. A block that such
runs cover is to be removed, and the unique runs stay. Pages with equal streams count as one, so mirrored pages don't remove each
other. A check by structure follows. Scripts, styles, menus, headers, footers, sidebars, notices, adverts, forms and reader
comments are known by their elements, roles and class names, and go though they be unique; what stands in an article or main element
is the article, and stays though other articles share it. On a page without such an element, any other block goes by the array.
Class names never speak against an article or main element itself, nor "header" inside
one, nor ids against headings and running text.

A host may hold any share of the pages. One of over SHARD_PAGES pages or SHARD_BYTES bytes is dealt into shards of about so many;
each shard has its suffix array, and if any of the host's pages is in doubt, the arrays' runs are counted over the whole host by
their hashes, and each shard gets back those of its own that recur.

Defined cases: a null or empty page has an empty text; repeated rows are extracted each; a null url is a host of its own;
other columns are ignored; an empty table gives an empty result; long pages are parsed whole.
"""

from __future__ import annotations

import collections
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import shared
from gleanery.llm.shingles import mixed

RESULT = "page_id long, url string, text string, n_chars long"
SHARD_PAGES = 256
SHARD_BYTES = 8 << 20
#: Bytes of html in a partition of shards, about.
PARTITION_BYTES = 128 << 20
MIN_RUN = 8
MIN_PAGES = 3
#: Share of a block's tokens that recurring runs must cover to remove it.
COVERED = 0.8

# Elements whose content isn't text of the page, is never the article, or stands on its own line.
RAW = "script|style|textarea|title|iframe|noembed|noframes|xmp|template|svg|math|object|select|noscript"
NEVER = frozenset("nav aside form footer button dialog menu head fieldset label option datalist audio video canvas map".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section
summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that aren't kept open: they exclude nothing, and pages often leave them open.
LOOSE = frozenset("p b i em strong u s a span small big font tt code sub sup mark abbr cite q li dt dd tr td th thead tbody tfoot option".split())
# Class names, ids and roles of what isn't the article.
HINT = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|menubar|breadcrumbs?|header|masthead|footer|contentinfo|sidebar|aside|complementary|ads?|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|banner|"
    r"notice|cookies?|consent|gdpr|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|related|recommended|comments?|disqus|replies|respond|widget|toolbar|pagination|pager|skip|copyright|legal|alert)(?:$|[\s_-])"
)
#: Of these, what names a part of the article inside it.
OF_ARTICLE = re.compile(r"(?<![^\s_-])(?:header|masthead)(?![^\s_-])")
#: Elements whose ids are marks to jump to.
MARKED = frozenset("h1 h2 h3 h4 h5 h6 hgroup a blockquote pre figure figcaption caption".split()) | LOOSE
MAIN_ROLE = re.compile(r"""role\s*=\s*["']?(?:main|article)\b""")
NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?<![\w-])hidden(?=[\s=/>]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
MARKUP = re.compile(rf"""<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])(?:[^<>"']|"[^"]*"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[A-Za-z/!?](?:[^<>"']|"[^"]*"|'[^']*')*>|<[A-Za-z/!?][^>]*(?:>|\Z)""", re.S | re.I)
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)(.*)", re.S)
WORD = re.compile(r"\S+")


def against(name: str, rest: str, article: bool) -> bool:
    """Whether the class names, id and role of an element speak against its being of the article."""
    named = " ".join("".join(t[1:]) for t in NAMES.findall(rest) if not (name in MARKED and t[0].lower() == "id")).lower()
    if article:
        named = OF_ARTICLE.sub("", named)
    return bool(named and HINT.search(named))


def blocks_of(page: str) -> list[tuple[str, int]]:
    """The blocks of a page in order: text, and 2 in its article, 1 if nothing speaks for or against it, 0 if it can't be of it."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # element, left out, in the article
    n_open: collections.Counter[str] = collections.Counter()
    left_out = article = False

    def end_block() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, 0 if left_out else 2 if article else 1))

    at = 0
    for m in MARKUP.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        if m.group(1):
            continue
        tag = TAG.match(m.group())
        if not tag:
            continue
        name = tag.group(2).lower()
        if name == "br":
            held.append(" ")
            continue
        if name in BLOCKS:
            end_block()
        if name in VOID:
            continue
        if tag.group(1):
            if n_open[name]:
                end_block()
                closed = ""
                while closed != name:
                    closed = open_.pop()[0]
                    n_open[closed] -= 1
                left_out, article = open_[-1][1:] if open_ else (False, False)
            continue
        rest = tag.group(3)
        is_main = name in ("article", "main") or "role" in rest and bool(MAIN_ROLE.search(rest))
        out_ = name in NEVER or name == "header" and not article or (len(rest) > 6 and bool(HIDDEN.search(rest)))
        if "=" in rest and not (out_ or is_main or name in ("html", "body")):
            out_ = against(name, rest, article)
        if name in LOOSE and not out_ and not is_main:
            continue
        if out_ != left_out or is_main:
            end_block()
        n_open[name] += 1
        open_.append((name, left_out or out_, article or is_main))
        left_out, article = open_[-1][1:]
    if at < len(page):
        held.append(page[at:])
    end_block()
    return out


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of a token stream in order, and for each the length of what it begins with like the one before.

    Ranks of the first 1, 2, 4, … tokens are made from each other until all differ; two suffixes have in common what the
    largest depths, from the deepest down, say one after another.
    """
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    levels = [rank.astype(np.int32)]
    while n and int(rank.max()) + 1 < n:
        following = np.full(n, -1, dtype=np.int64)
        step = 1 << (len(levels) - 1)
        following[: n - step] = rank[step:]
        rank = np.unique(rank * (n + 2) + following + 1, return_inverse=True)[1].astype(np.int64)
        levels.append(rank.astype(np.int32))
    order = np.argsort(rank)
    common = np.zeros(n, dtype=np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((left < n) & (right < n))
        same = inside[levels[k][left[inside]] == levels[k][right[inside]]]
        common[same + 1] += 1 << k
        left[same] += 1 << k
        right[same] += 1 << k
    return order, common


def recurring(streams: list[np.ndarray], min_run: int = MIN_RUN, min_pages: int = MIN_PAGES, runs: list[np.ndarray] | None = None, often: np.ndarray | None = None) -> list[np.ndarray]:
    """For each stream of tokens, which of them lie in a run of min_run tokens that recurs on min_pages distinct streams, or of which
    it is known by its number that it does elsewhere (runs: of each stream, in order; often: those that recur).

    Neighbours in the suffix array of all streams together that have min_run tokens in common begin with the same run.
    """
    kept: dict[bytes, int] = {}
    same = [kept.setdefault(s.tobytes(), len(kept)) for s in streams]
    firsts = np.unique(same, return_index=True)[1].tolist()
    n = sum(len(streams[i]) + 1 for i in firsts)
    if not n:
        return []
    text = np.empty(n, dtype=np.int64)
    owner = np.empty(n, dtype=np.int64)
    known = np.zeros(n, dtype=bool)
    starts, at, base = [], 0, 1 + max((int(s.max()) for s in streams if len(s)), default=0)
    for k, i in enumerate(firsts):
        s = streams[i]
        text[at : at + len(s)] = s
        text[at + len(s)] = base + k  # an end that is like no other, so no run goes over from one page to the next
        owner[at : at + len(s) + 1] = k
        if often is not None:
            known[at : at + len(runs[i])] = np.isin(runs[i], often)
        starts.append(at)
        at += len(s) + 1
    order, common = suffix_array(text)
    run = np.cumsum(common < min_run) - 1
    pages = np.bincount(np.unique(run * len(firsts) + owner[order]) // len(firsts))
    known_runs = np.bincount(run, weights=known[order]) > 0
    hits = order[(pages[run] >= min_pages) | known_runs[run]]
    mark = np.zeros(n + 1, dtype=np.int64)
    np.add.at(mark, hits, 1)
    np.subtract.at(mark, np.minimum(hits + min_run, n), 1)
    covered = np.cumsum(mark)[:n] > 0
    return [covered[starts[k] : starts[k] + len(s)] for k, s in zip(same, streams, strict=True)]


def in_doubt(blocks: list[tuple[str, int]]) -> bool:
    return not any(k == 2 for _, k in blocks) and any(k == 1 for _, k in blocks)


def runs_of(blocks: list[tuple[str, int]], min_run: int = MIN_RUN) -> tuple[np.ndarray, int]:
    """A number for each run of min_run tokens of a page, in order, and one for its whole stream."""
    import xxhash

    words = [w.encode("utf-8", "surrogatepass") for text, _ in blocks for w in WORD.findall(text)]
    numbers = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    out = np.zeros(max(0, len(words) - min_run + 1), dtype=np.uint64)
    for k in range(min_run):
        out = mixed(out + numbers[k : k + len(out)])
    return out.view(np.int64), xxhash.xxh3_64_intdigest(numbers.tobytes()) - (1 << 63)


def main_texts(pages: list[str], min_run: int = MIN_RUN, min_pages: int = MIN_PAGES, often: np.ndarray | None = None) -> list[str]:
    """The main text of each page of a shard. often: the runs that recur on the host, where the shard isn't all of it."""
    parsed = [blocks_of(p) for p in pages]
    words = [[WORD.findall(text) for text, _ in blocks] for blocks in parsed]
    numbers: dict[str, int] = {}
    streams = [np.array([numbers.setdefault(w, len(numbers)) for block in page for w in block], dtype=np.int64) for page in words]
    runs = [runs_of(blocks, min_run)[0] for blocks in parsed] if often is not None and len(often) else None
    covered = recurring(streams, min_run, min_pages, runs, often if runs is not None else None)
    out = []
    for blocks, page, of_page in zip(parsed, words, covered, strict=True):
        article, at, kept = any(k == 2 for _, k in blocks), 0, []
        for (text, kind), block in zip(blocks, page, strict=True):
            n = len(block)
            recurs = n > 0 and of_page[at : at + n].mean() >= COVERED
            at += n
            if kind == 2 or kind == 1 and not article and not recurs:
                kept.append(text)
        out.append("\n\n".join(kept))
    return out


def extracted(pages: DataFrame, shard_pages: int = SHARD_PAGES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """RESULT for each page."""
    spark = pages.sparkSession
    shared.ship(spark)
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))
    sizes = rows.select(host.alias("host"), F.octet_length("html").alias("size")).groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    sizes = shared.written(sizes, "hosts")
    total, size = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    hosted = shared.join_groups(rows.withColumn("host", host), sizes, "host", "n", total)
    shards = F.greatest(F.ceil(F.coalesce("n", F.lit(1)) / shard_pages), F.ceil(F.coalesce("size", F.lit(0)) / shard_bytes))
    dealt = hosted.withColumn("shard", F.pmod(F.xxhash64("page_id", "url"), shards)).withColumn("in_shards", shards > 1)
    ddl = RESULT

    def hosts_in_doubt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in shared.slices(batches, "html"):
            hosts = zip(batch.column("host").to_pylist(), batch.column("n").to_pylist(), shared.texts_of(batch, "html"), strict=True)
            found = {h: n for h, n, page in hosts if h not in seen and in_doubt(blocks_of(page))}
            seen |= set(found)
            if found:
                yield pa.RecordBatch.from_pydict({"host": list(found), "n": list(found.values())}, schema=shared.schema_of("host string, n long"))

    def page_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = shared.schema_of("host string, shard long, run long, stream long")
        for batch in shared.slices(batches, "html", most=1 << 20):
            for host_, shard, page in zip(batch.column("host").to_pylist(), batch.column("shard").to_pylist(), shared.texts_of(batch, "html"), strict=True):
                runs, stream = runs_of(blocks_of(page))
                runs = np.unique(runs)
                if len(runs):
                    yield pa.RecordBatch.from_pydict({"host": [host_] * len(runs), "shard": [shard] * len(runs), "run": runs, "stream": [stream] * len(runs)}, schema=schema)

    large = dealt.where("in_shards").select("host", "shard", "html", "n")
    doubted = shared.written(large.select("host", "n", "html").mapInArrow(hosts_in_doubt, "host string, n long").distinct().withColumn("doubted", F.lit(True)), "hosts-in-doubt")
    runs = shared.join_groups(large.drop("n"), doubted, "host", "n", total).where("doubted").select("host", "shard", "html").mapInArrow(page_runs, "host string, shard long, run long, stream long")
    runs = shared.written(runs, "runs")
    often = runs.select("host", "run", "stream").distinct().groupBy("host", "run").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {MIN_PAGES}")
    given = runs.select("host", "shard", "run").distinct().join(often.select("host", "run"), ["host", "run"]).select("host", "shard", "run")

    def extract(table: pa.Table, recurring_runs: pa.Table) -> pa.Table:
        pages_ = [x or "" for x in table.column("html").to_pylist()]
        in_shards = table.num_rows and table.column("in_shards")[0].as_py()
        texts = main_texts(pages_, often=recurring_runs.column("run").to_numpy() if in_shards else None)
        return pa.table({"page_id": table.column("page_id"), "url": table.column("url"), "text": texts, "n_chars": [len(x) for x in texts]}, schema=shared.schema_of(ddl))

    dealt, partitions = dealt.drop("n", "size"), size // PARTITION_BYTES + 1
    if partitions > int(spark.conf.get("spark.sql.shuffle.partitions")):
        dealt = dealt.repartition(partitions, "host", "shard")
    return dealt.groupBy("host", "shard").cogroup(given.groupBy("host", "shard")).applyInArrow(extract, RESULT)
