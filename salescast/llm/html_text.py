"""The main text of web pages: markup first, then a suffix array over each host's remaining text.

Markup names most of what is not the article: elements such as ``nav`` and ``footer``, roles, and words in ``class`` and ``id``
(``ad``, ``cookie``, ``comments``). Text in these is dropped. If a page marks its main text (``article``, ``main``), what lies
outside is dropped as well, and all inside stays, even if other pages repeat it, as articles do quote each other.
Words of ``class`` and ``id`` also describe layouts (``right-sidebar``, ``cookies-not-set``), so they say nothing on ``html`` and
``body``, nor outside main parts on elements that hold one, unless they name what follows an article (``REPLIES``) and a
main part came before. Inside main parts they count on containers only, where a whole name says so (``share-buttons``, not
``share-price``), and the ids of headings and sections are topics.

Pages that mark no main text keep unmarked text, in which menus and notices can still stand. Inside main parts, blocks whose names
hint at what is no article without saying so (``notice``, ``share-price``) are doubted. Both are decided by a suffix array: the words
of each page in main parts make a stream, those outside with the doubted ones another, and the suffixes of all streams of a host, from
every page, are sorted by prefix doubling. Its letters are ``LONG`` consecutive words, in the order of their hashes. A round ranks the distinct
pairs of a suffix's rank and of that as many words on, so ranks stand for twice as many words. Suffixes that fewer than ``PAGES`` distinct pages
share so far have no longer repeat and leave. How far a suffix stayed is the length of the prefix that it shares with its
neighbours in the array. Words in prefixes that as many pages share outside main parts are repeats: they go, unless they are a short part
of a block; unique runs stay. Undoubted text of main parts is kept whatever repeats, and what only main parts repeat is no notice: an
article doesn't become one where others quote it. Pages are counted over whole hosts by combinable aggregates, so neither the size of a
host nor the partitioning changes a result.

Most suffixes share their first letter with no other page. Of the grams of ``GRAM`` words in a letter one has the least hash; equal letters have
it in common, so a letter leaves before the first round if fewer than ``PAGES`` rows of its host have its gram as such. Grams are
counted exactly; those on enough rows are sent to the tasks as ``BITS`` bits, where two of one place only let more letters through.

Edge cases: null and empty html give an empty text. A page that ends within a tag, comment or script loses that part only.
A null url is a host of its own. Repeated rows are answered row by row, and count as one page (same page_id) when repeats
are counted. Html is read whole, and once. Other columns are not read.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.text import SPACED, Words, mix, runs
from salescast.session import discard, materialize, shuffles_deleted

#: Words of a letter and of a repeated substring, distinct pages that have it, and parts that a common one is dealt over.
LONG, PAGES, SALT = 10, 3, 8
#: Words of a gram, parts that their hashes are dealt over, and places of the bitmap of shared ones (8 MB before it is packed).
GRAM, BUCKETS, BITS = 5, 1 << 10, 1 << 26

#: Elements without text for readers, void elements, elements that end a block.
SILENT = frozenset("script style noscript template head title svg annotation annotation-xml canvas object iframe textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body br button caption dd details dialog div dl dt fieldset figcaption
 figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section select summary
 table tbody td tfoot th thead title tr ul""".split())
#: Elements, roles and words of class or id whose text is no article.
OUTSIDE = frozenset("nav footer aside form button select menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
WORDS = frozenset("""ad ads advert advertisement adverts adsense sponsor sponsored promo promotion banner cookie cookies consent
 gdpr notice notices alert popup modal overlay sidebar side aside menu nav navbar navigation breadcrumb breadcrumbs footer foot
 copyright legal disclaimer comment comments disqus reply replies respond share sharing social related recommended newsletter
 subscribe signup login search pagination pager widget toolbar skip""".split())
#: Of these, the ones whose elements hold articles that aren't the page's own.
REPLIES = frozenset("comment comments disqus reply replies respond related recommended".split())
#: Inside main parts: elements that can hold more than a passage, words of names that are no topics there, and words beside them.
CONTAINERS = frozenset("div ul ol dl aside section table".split())
INNER = WORDS - frozenset("legal copyright disclaimer notice notices alert side foot promotion banner skip search".split())
ADVERTS = frozenset("ad ads advert advertisement sponsored".split())  # whole names that say so on any element
COMPANY = frozenset("""area bar block box btn button buttons container content form group icons inner item items label layer links
 list module notice panel post posts row section slot thread title top bottom unit wrap wrapper""".split())
#: Elements whose ids inside a main part are topics; of headings, the classes too.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TOPICS = HEADINGS | {"section"}
#: These mean the page's own head only outside the main part; inside it is the article's.
HEADS = frozenset({"header", "masthead"})
MAIN = frozenset({"article", "main"})

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)"
                   r"|<[a-zA-Z][^>]*\Z|<[a-zA-Z][^>]*>|[^<]+|<", re.DOTALL)
MARK = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SILENT_END = {name: re.compile(rf"</{name}\s*(?:/[^>]*)?>", re.IGNORECASE) for name in SILENT}
RAW = frozenset("script style textarea title iframe noscript".split())

IN_MAIN, DROPPED, PLAIN, DOUBTED = 0, 1, 2, 3
KEPT = frozenset({IN_MAIN, DOUBTED})


def _tokens(page: str) -> Iterator[re.Match]:
    """Tags, comments and texts in order, without the content of raw elements."""
    at = 0
    while token := TOKEN.match(page, at):
        yield token
        at = token.end()
        if token[2] and not token[1] and (name := token[2].lower()) in RAW:
            end = SILENT_END[name].search(page, at)
            at = end.end() if end else len(page)


def _is_main(name: str, attributes: str) -> bool:
    return name in MAIN or "role" in attributes.lower() and any(
        m[1].lower() == "role" and (m[2] or m[3] or m[4] or "").lower() in MAIN for m in MARK.finditer(attributes))


def _holders(page: str) -> set[int]:
    """Where the elements start that hold a main part."""
    out: set[int] = set()
    stack: list[tuple[str, int]] = []
    for token in _tokens(page):
        if token[2] is None or (name := token[2].lower()) in RAW or name in VOID:
            continue
        if token[1]:
            if any(name == open_ for open_, _ in stack):
                while stack.pop()[0] != name:
                    pass
            continue
        if name == "p" and stack and stack[-1][0] == "p":
            stack.pop()
        if _is_main(name, token[3]):
            for _, start in reversed(stack):
                if start in out:  # and so are those around it
                    break
                out.add(start)
        stack.append((name, token.start()))
    return out


def _names_inner(name: str) -> bool:
    """Whether a whole class or id names what is no article even inside one."""
    parts = {p.lower() for p in PART.findall(name)}
    return bool(parts & INNER) and parts <= INNER | COMPANY


def _kind(name: str, attributes: str, inside: bool, holds: Callable[[], bool], before: bool) -> int | None:
    """What an element makes of the text in it; None: nothing new.

    ``inside`` a main part, whether it ``holds`` one, and whether one came ``before``.
    """
    if name in SILENT or name in OUTSIDE:
        return DROPPED
    main, head, doubt = name in MAIN, name in HEADS, False
    if attributes and "=" in attributes or "hidden" in attributes:
        for found in MARK.finditer(attributes):
            key, value = found[1].lower(), found[2] or found[3] or found[4] or ""
            if key == "role":
                if value.lower() in ROLES:
                    return DROPPED
                main |= value.lower() in ("main", "article")
            elif key == "hidden" and not found[0].startswith("aria") or key == "aria-hidden" and value.lower() == "true":
                return DROPPED
            elif key in ("class", "id"):
                parts = {p.lower() for p in PART.findall(value)}
                if name in MAIN or name in ("html", "body"):
                    says = False
                elif inside:
                    topic = name in (TOPICS if key == "id" else HEADINGS)
                    says = (name in CONTAINERS and not topic and any(map(_names_inner, value.split()))
                            or not ADVERTS.isdisjoint(value.lower().split()))
                    doubt |= name in BLOCKS and not topic and not WORDS.isdisjoint(parts)
                else:
                    says = parts & WORDS and (before and parts & REPLIES or not (_is_main(name, attributes) or holds()))
                if says:
                    return DROPPED
                head |= bool(parts & HEADS) and name not in ("html", "body") and (inside or not holds())
    if main:
        return IN_MAIN
    if doubt:
        return DOUBTED
    return DROPPED if head and not inside else None


def blocks(page: str) -> list[tuple[int, str]]:
    """The texts of a page's blocks in order, each with IN_MAIN, DROPPED or PLAIN, as markup alone has it."""
    return [(IN_MAIN if kind in KEPT else kind, text) for kind, text in _blocks(page)]


def _blocks(page: str) -> list[tuple[int, str]]:
    """The same with DOUBTED for blocks of main parts in elements whose names only hint at what is no article."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    now, parts = PLAIN, []
    holders: set[int] | None = None
    before = False

    def holds() -> bool:
        nonlocal holders
        if holders is None:
            holders = _holders(page)
        return token.start() in holders

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append((now, text))
        parts.clear()

    for token in _tokens(page):
        name = token[2]
        if name is None:
            if token[0][0] != "<" or token[0] == "<":
                parts.append(html.unescape(token[0]))
            continue
        name = name.lower()
        if name in BLOCKS:
            flush()
        if token[1]:
            if any(name == open_ for open_, _ in stack):
                while True:
                    open_, outer = stack.pop()
                    if outer != now:
                        if not KEPT.issuperset((outer, now)):
                            flush()
                        now = outer
                    if open_ == name:
                        break
            continue
        if name in RAW or name in VOID:
            continue
        if name == "p" and stack and stack[-1][0] == "p":
            now = stack.pop()[1]
        kind = now if now == DROPPED else _kind(name, token[3], now in KEPT, holds, before)
        before = before or kind == IN_MAIN
        stack.append((name, now))
        if kind is not None and kind != now:
            if not KEPT.issuperset((kind, now)):
                flush()
            now = kind
    flush()
    return out


def _letters(words: Words, host: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row and place of each suffix that has ``LONG`` words within its row, and 42 bits of the least gram in these, by ``host`` of the row."""
    hashes, rows = words.hashes(), words.rows()
    n = max(0, len(words) - LONG + 1)
    gram = np.zeros(max(0, len(words) - GRAM + 1), np.uint64)
    for k in range(GRAM):
        gram = gram * _FACTOR + hashes[k: k + len(gram)]
    mix(gram)
    least = reduce(np.minimum, (gram[k: k + n] for k in range(LONG - GRAM + 1)))
    at = np.flatnonzero(rows[:n] == rows[LONG - 1: LONG - 1 + n])
    row = rows[at]
    return row, at, mix(least[at] ^ host[row]) >> np.uint64(22)


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _prefixes(words: Words, at: np.ndarray) -> np.ndarray:
    """The hash of the ``LONG`` words from each of these on."""
    hashes, key = words.hashes(), np.zeros(len(at), np.uint64)
    for k in range(LONG):
        key = mix(key + hashes[at + k])
    return key.view(np.int64)


def unique_words(stream: str, sizes: list[int], main: list[str], repeats: list[tuple[int, int]]) -> str:
    """The text of a page without the words that repeats cover, each given by its first word and length.

    ``sizes`` are the blocks' numbers of words in the stream, negative where they are dropped anyway, 0 for the next text of ``main``. What a
    repeat covers of a block by reaching into it from a neighbour, fewer than ``LONG`` words and not all of it, stays: texts can begin alike
    after the same menu.
    """
    words = stream.split(" ")
    steps = np.zeros(len(words) + 1, np.int64)
    if repeats:
        first, length = np.array(repeats, np.int64).T
        np.add.at(steps, first, 1)
        np.add.at(steps, first + length, -1)
    covered, kept, out, at = np.cumsum(steps)[:-1] > 0, iter(main), [], 0
    for size in sizes:
        if not size:
            out.append(next(kept))
        own = covered[at: at + abs(size)]
        if size > 0 and not own.all():
            edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]])))
            gone = np.zeros(size, bool)
            for begin, end in zip(edges[::2], edges[1::2]):
                gone[begin:end] = end - begin >= LONG
            out += [w for w, drop in zip(words[at: at + size], gone) if not drop]
        at += abs(size)
    return " ".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for each row of ``pages`` (page_id, url, html)."""
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("text"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1)), F.lit("?"))
    rows = pages.withColumn("host", host).withColumn("key", F.monotonically_increasing_id())
    kind = rows.schema["page_id"].dataType.simpleString()

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The text of pages without blocks in question, of others null and what is needed to make it; and the stream of each."""
        for batch in batches:
            for part in runs(batch, "text", 8 << 20):
                columns = [_parts(page or "") for page in part["text"].to_pylist()]
                texts, streams, sizes, mains = zip(*columns)
                yield pa.RecordBatch.from_pydict({
                    "host": part["host"], "key": part["key"], "page_id": part["page_id"], "url": part["url"],
                    "text": pa.array(texts, pa.string()), "stream": pa.array(streams, pa.string()),
                    "sizes": pa.array(sizes, pa.list_(pa.int32())), "main": pa.array(mains, pa.list_(pa.string()))})

    with shuffles_deleted(pages.sparkSession):
        found = materialize(rows.select("host", "key", "page_id", "url", "text").mapInArrow(
            parsed, f"host string, key bigint, page_id {kind}, url string, text string, stream string, sizes array<int>, main array<string>"),
            "page-blocks", compression="zstd")
        array = suffix_array(_suffixes(found))
    open_ = found.where("text is null").select("key", "page_id", "url", "stream", "sizes", "main")
    repeats = array.where("open and common and not inside").groupBy(F.col("key").alias("row")).agg(  # of one page each
        F.collect_list(F.struct("place", "length")).alias("repeats"))

    def unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for stream, sizes, main, shared in zip(*(batch[c].to_pylist() for c in ("stream", "sizes", "main", "repeats"))):
                texts.append(unique_words(stream, sizes, main, [(r["place"], r["length"]) for r in shared or []]))
            yield pa.RecordBatch.from_pydict({"page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string())})

    decided = open_.join(repeats, F.col("key") == F.col("row"), "left").select(
        "page_id", "url", "stream", "sizes", "main", "repeats").mapInArrow(unique, f"page_id {kind}, url string, text string")
    texts = found.where("text is not null").select("page_id", "url", "text").unionByName(decided)
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def _parts(page: str) -> tuple[str | None, str, list[int] | None, list[str] | None]:
    """A page's text, or null where blocks are in question; its stream; and the sizes and main texts for ``unique_words``."""
    found = _blocks(page)
    if all(k != IN_MAIN for k, _ in found):  # doubts about all of a main part say nothing
        found = [(IN_MAIN if k == DOUBTED else k, t) for k, t in found]
    main = [t for k, t in found if k == IN_MAIN]
    asked = DOUBTED if main else PLAIN
    stream = " ".join(t for k, t in found if k != IN_MAIN)
    if all(k != asked for k, _ in found):
        return " ".join(main), stream, None, None
    return None, stream, [0 if k == IN_MAIN else (t.count(" ") + 1) * (1 if k == asked else -1) for k, t in found], main


def _suffixes(found: DataFrame) -> DataFrame:
    """The suffixes of all streams that may be shared: page and key of the row, whether the page is open and the stream inside main parts, place,
    the host as ``rank`` and the first letter as ``next``."""
    page = F.coalesce(F.concat(F.lit("p"), F.col("page_id").cast("string")), F.concat(F.lit("r"), F.col("key").cast("string")))
    main = F.coalesce("text", F.array_join("main", " ")) if "main" in found.columns else F.lit("")
    both = [F.struct(F.lit(inside).alias("inside"), stream.alias("stream")) for inside, stream in ((False, F.col("stream")), (True, main))]
    streams = found.select(F.xxhash64("host").alias("rank"), F.xxhash64(page).alias("page"), "key", F.col("text").isNull().alias("open"),
                           F.inline(F.array(*both)))
    bits = zlib.compress(_shared_grams(streams), 1)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = np.frombuffer(zlib.decompress(bits), np.uint8)
        for batch in batches:
            for part in runs(batch, "stream", 4 << 20):
                words = Words(part["stream"], SPACED)
                row, at, gram = _letters(words, part["rank"].to_numpy().view(np.uint64))
                bit = gram >> np.uint64(42 - BITS.bit_length() + 1)
                kept = shared[bit >> np.uint64(3)] >> (~bit & np.uint64(7)).astype(np.uint8) & 1 > 0
                row, at = row[kept], at[kept]
                yield pa.RecordBatch.from_pydict({
                    **{c: part[c].take(pa.array(row)) for c in ("rank", "page", "key", "open", "inside")},
                    "place": pa.array((at - words.first[row]).astype(np.int32)), "next": pa.array(_prefixes(words, at))})

    return streams.mapInArrow(suffixes, "rank bigint, page bigint, key bigint, open boolean, inside boolean, place int, next bigint")


def _shared_grams(streams: DataFrame) -> bytes:
    """A bit for each of the ``BITS`` values of a hash, 1 where a gram of it is the least one of letters in ``PAGES`` rows of a host or more."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "stream", 4 << 20):
                row, _, gram = _letters(Words(part["stream"], SPACED), part["rank"].to_numpy().view(np.uint64))
                order = np.lexsort((row, gram))
                row, gram = row[order], gram[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
                gram, count = np.unique(gram[new], return_counts=True)
                count = np.minimum(count, PAGES).astype(np.uint8)
                buckets, begin = np.unique(gram >> np.uint64(32), return_index=True)
                ends = [*begin[1:], len(gram)]
                rest = gram.astype(np.uint32)  # the lower half
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(buckets.astype(np.int32)),
                    "grams": pa.array([rest[a:b].tobytes() for a, b in zip(begin, ends)], pa.binary()),
                    "counts": pa.array([count[a:b].tobytes() for a, b in zip(begin, ends)], pa.binary())})

    def shared(rows: pa.Table) -> pa.Table:
        grams, counts = (np.frombuffer(b"".join(rows[c].to_pylist()), kind) for c, kind in (("grams", np.uint32), ("counts", np.uint8)))
        grams, which = np.unique(grams, return_inverse=True)
        places = np.zeros(BITS // BUCKETS, np.uint8)
        places[(grams // (2 ** 32 // len(places)))[np.bincount(which, counts, len(grams)) >= PAGES]] = 1
        bits = zlib.compress(np.packbits(places).tobytes(), 1)
        return pa.table({"bucket": rows["bucket"].slice(0, 1), "bits": pa.array([bits], pa.binary())})

    found = streams.select("rank", "stream").mapInArrow(counted, "bucket int, grams binary, counts binary")
    out = np.zeros((BUCKETS, BITS // BUCKETS // 8), np.uint8)
    for bucket, bits in found.groupBy("bucket").applyInArrow(shared, "bucket int, bits binary").collect():
        out[bucket] = np.frombuffer(zlib.decompress(bits), np.uint8)
    return out.tobytes()


def suffix_array(suffixes: DataFrame) -> DataFrame:
    """The part of the suffix array that ``PAGES`` pages of a host share: key, open, inside, common, place, rank and length, in words, of each suffix.

    Rows of one length are in the array's order by ``rank``, and equal in rank if they share as many words; ``common`` if as many
    pages have them outside main parts. A suffix has a row for each length from ``LONG`` on, doubled up to the last that it shares.
    """
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long")))
    salt = F.pmod(F.xxhash64("key"), F.lit(SALT))
    now, length, levels = suffixes, LONG, []
    while True:
        holders = now.groupBy("rank", "next", "page").agg(F.bool_or(~F.col("inside")).alias("outside"))
        pairs = holders.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("pages"), F.count_if("outside").alias("outside"))
        # Ids of sorted rows increase; pairs are distinct here, so a repeat on many pages is one row of the sort.
        ranks = materialize(pairs.where(F.col("pages") >= PAGES).orderBy("rank", "next").select(
            F.col("rank").alias("first"), F.col("next").alias("second"), F.monotonically_increasing_id().alias("name"),
            (F.col("outside") >= PAGES).alias("common")), "suffix-ranks")
        # As many ranks as there are repeats: never broadcast.
        shared = now.join(ranks.withColumn("salt", salts).hint("merge"), (F.col("rank") == F.col("first"))
                          & (F.col("next") == F.col("second")) & (salt == F.col("salt")))
        # In the order of the streams a page's hash and key take no room, here and in the next shuffle.
        level = materialize(shared.select("page", "key", "open", "inside", "common", "place", F.col("name").alias("rank")).sortWithinPartitions(
            "key", "inside", "place"), "suffixes", compression="zstd")
        discard(ranks)
        levels.append(level.select("key", "open", "inside", "common", "place", "rank", F.lit(length).alias("length")))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        on = Window.partitionBy("key", "inside").orderBy("place").rangeBetween(length, length)  # of one page
        now = level.drop("common").withColumn("next", F.first("rank").over(on)).where("next is not null")
        length *= 2
