"""WARC derivatives: response records to metadata and conversion records (operator 5).

``derive`` reads whole response records and writes for each a ``metadata`` record
with its title, the source's digests, its WARC headers and its HTTP headers, and,
if the payload is text, a ``conversion`` record with its plain text. Both refer to
the response's id, date and address, and the metadata record to the conversion.
Column expressions only; records stay in their partition and nothing shuffles.

The source's own payload digest is kept as it is written. It is compared with the
payload where it is sha256, sha1 or md5 in hex, or sha1 in base 32; of others
nothing is said. A payload is text if its media type is text, XML, JSON or
JavaScript, or is not given, and it has no content encoding; tags are taken out of
HTML and XML, and of payloads without a type. A ``record`` column may be text or
bytes; bytes are read by the charset of the HTTP header (the Latin-1 family, which
HTML takes as windows-1252; all others as UTF-8, where bad bytes become U+FFFD).

``save`` writes records as a WARC file per partition, ``responses`` builds
response records from a table of pages.

Defined cases: a null record is dropped; a record of another type is passed
over; a record or HTTP block without an empty line has headers only and an
empty payload; absent headers are left out of derived records; a null url or
html counts as empty; pages of any length and however broken are read whole, in
linear time; of headers that are there twice (a tie) the first counts; repeated rows
give repeated records; extra columns, whatever their names, are
kept by ``derive`` only if named; an empty table gives no records.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

#: Line end, end of a header block, end of a record.
CRLF, BLANK = "\r\n", "\r\n\r\n"
#: Fixed value: tags that end a line; all others stand within one.
BLOCK_TAGS = (
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav "
    "noframes noscript ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead "
    "title tr ul xmp").split()
#: Text extraction, in order (pattern, replacement): what is not
#: text goes (up to the end of the page, if it is never closed), block tags end a
#: line, all other tags go, white space shrinks.
NO_TEXT = r"(?is)<(?:!--.*?(?:-->|\z)|script\b.*?(?:</script\s*>|\z)|style\b.*?(?:</style\s*>|\z))"
# The tags by their first letter, so that a pattern looks at few of them.
_BY_LETTER = "|".join(f"{c}(?:{'|'.join(t[1:] for t in BLOCK_TAGS if t[0] == c)})"
                      for c in dict.fromkeys(t[0] for t in BLOCK_TAGS))
TAG_RULES = (
    (rf"(?i)</?(?:{_BY_LETTER})(?![\w-])[^>]*>", "\n"),
    (r"<[^>]*>", ""),
)
SPACE_RULES = (
    (r"[ \t\r\x0B\f](?:[ \t\r\x0B\f]+|(?<! ))", " "),
    (r" ?\n[ \n]*", "\n"),
)
#: The most frequent entities, decoded alone where a text has no others; the ampersand last.
ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
#: The named entities of HTML 4 and &apos;; a no-break space becomes a space.
NAMED = {n: chr(c) for n, c in name2codepoint.items()} | {"apos": "'", "nbsp": " "}
#: Numbers that stand for another character, as HTML has it.
NUMBERS = {0: 0xFFFD, 0xA0: 0x20} | {c: ord(bytes([c]).decode("cp1252", "replace")) for c in range(0x80, 0xA0)
                                    if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
#: Media types that are text; those of them whose tags are taken out.
TEXT_TYPES = r"^text/|[/+](?:xml|xhtml|json)$|^application/(?:x-)?(?:javascript|ecmascript)$"
TAGGED_TYPES = r"html|[/+]xml$"
#: Charset labels that HTML reads as windows-1252, and that table's characters.
LATIN = ("iso-8859-1", "latin1", "windows-1252", "cp1252", "us-ascii", "ascii")
CP1252 = ("".join(map(chr, (c for c in NUMBERS if 0x80 <= c < 0xA0))),
          "".join(chr(n) for c, n in NUMBERS.items() if 0x80 <= c < 0xA0))
#: WARC headers that derived records carry on their own, or that concern the response's form only.
CARRIED = ("WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest", "WARC-Block-Digest",
           "Content-Type", "Content-Length")
_REFERENCE = r"(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def record_id(*seed: Column) -> Column:
    """A urn:uuid made from the seed, so that reruns give the same ids."""
    h = F.md5(F.concat_ws("\x1f", *seed))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4),
                    F.lit("-"), part(17, 4), F.lit("-"), part(21, 12), F.lit(">"))


def _numbered(reference: Column) -> Column:
    """Character of a numeric reference (#233 or #xE9); those of none give U+FFFD."""
    hexadecimal = F.substring(reference, 2, 1).isin("x", "X")
    digits = F.regexp_replace(reference, "^#[xX]?0*", "")
    base = lambda n: F.conv(digits, n, 10).cast("int")
    number = (F.when(F.length(digits) > 7, F.lit(0xFFFD)).when(digits == "", F.lit(0))
              .when(hexadecimal, base(16)).otherwise(base(10)))
    other = F.create_map(*[F.lit(x) for kv in NUMBERS.items() for x in kv])
    number = F.when((number > 0x10FFFF) | number.between(0xD800, 0xDFFF), F.lit(0xFFFD)).otherwise(
        F.coalesce(F.element_at(other, number), number))
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def decode_entities(text: Column) -> Column:
    """Each reference once, named ones and numbers; unknown names stay. Most
    texts have the frequent ones only, so one look for others saves the rest."""
    frequent = text
    for entity, char in ENTITIES:
        frequent = F.replace(frequent, F.lit(entity), F.lit(char))
    named = F.create_map(*[F.lit(x) for kv in NAMED.items() for x in kv])

    def decoded(piece: Column) -> Column:
        reference = F.regexp_extract(piece, f"^({_REFERENCE[:-1]});", 1)
        char = (F.when(reference == "", F.lit(None)).when(F.startswith(reference, F.lit("#")), _numbered(reference))
                .otherwise(F.element_at(named, reference)))
        return F.coalesce(F.concat(char, F.substr(piece, F.length(reference) + 2)), F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    every = F.concat(F.element_at(pieces, 1),
                     F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), decoded), ""))
    known = "|".join(e[1:-1] for e, _ in ENTITIES)
    return F.when(F.rlike(text, F.lit(f"&(?!(?:{known});){_REFERENCE}")), every).otherwise(frequent)


def _html_steps(html: Column) -> list:
    """``html_text`` in steps, each a function of the columns before it: what a step
    names more than once is then worked out once, as a column."""
    def cut(c):
        return F.left(c[0], F.length(c[0]) - F.length(c[1]))

    def shrunk(c):
        tagged = c[2]
        for pattern, to in TAG_RULES:
            tagged = F.regexp_replace(tagged, pattern, to)
        text = F.concat(tagged, c[1])
        for pattern, to in SPACE_RULES:
            text = F.regexp_replace(text, pattern, to)
        return F.btrim(text, F.lit(" \n"))

    return [lambda c: F.regexp_replace(html, NO_TEXT, ""), lambda c: F.substring_index(c[0], ">", -1), cut, shrunk,
            lambda c: decode_entities(c[3])]


def html_text(html: Column) -> Column:
    """Plain text of a page, in time linear in its length: what is never closed is
    matched once, to the end, and tags are looked for only up to the last ``>``,
    where each ``<`` has an end (what follows it holds no tag, and stays)."""
    done: list[Column] = []
    for step in _html_steps(html):
        done.append(step(done))
    return done[-1]


def with_html_text(rows: DataFrame, html: str, out: str) -> DataFrame:
    """``rows`` with ``html_text`` of column ``html`` as ``out``, step by step."""
    steps = _html_steps(F.col(html))
    names = [f"{out}_{i}" for i in range(len(steps) - 1)] + [out]
    for i, step in enumerate(steps):
        rows = rows.withColumn(names[i], step([F.col(n) for n in names[:i]]))
    return rows.drop(*names[:-1])


def title_html(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title[^>]*(?:>|\z)(.*?)(?:</title|\z)", 1)


def title(html: Column) -> Column:
    return html_text(title_html(html))


def header(head: Column, name: str) -> Column:
    """Value of a header, null if absent or empty; the first one counts."""
    return F.nullif(F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def split_head(whole: Column) -> tuple[Column, Column]:
    """(header lines, body) around the first empty line."""
    head = F.substring_index(whole, BLANK, 1)
    return head, F.substr(whole, F.length(head) + len(BLANK) + 1)


def _base32_hex(value: Column) -> Column:
    """Hex digits of 32 base-32 digits (a sha1), eight by eight."""
    digits = F.translate(F.upper(value), "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV")
    return F.lower(F.concat(*[F.lpad(F.conv(F.substring(digits, a, 8), 32, 16), 10, "0") for a in (1, 9, 17, 25)]))


def digest_match(said: Column, payload: Column) -> Column:
    """Whether a digest (``algorithm:value``) is that of the payload; null if it is
    null or of a kind that is not known. Only the algorithm it names is run."""
    kind, value = F.lower(F.substring_index(said, ":", 1)), F.substring_index(said, ":", -1)
    size = F.length(value)
    return (F.when((kind == "sha256") & (size == 64), F.lower(value) == F.sha2(payload, 256))
            .when((kind == "sha1") & (size == 40), F.lower(value) == F.sha1(payload))
            .when((kind == "sha1") & (size == 32), _base32_hex(value) == F.sha1(payload))
            .when((kind == "md5") & (size == 32), F.lower(value) == F.md5(payload)))


def header_lines(head: Column, mark: str, leave: tuple[str, ...] = ()) -> Column:
    """The header lines behind the first, each after ``mark``, without those named
    in ``leave`` and without empty ones; null if there are none."""
    lines = F.slice(F.split(head, CRLF), 2, F.length(head) + 1)
    if leave:
        lines = F.filter(lines, lambda x: ~F.lower(F.substring_index(x, ":", 1)).isin(*[n.lower() for n in leave]))
    marked = F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    return F.nullif(F.array_join(marked, CRLF), F.lit(""))


def _utf8(latin: Column) -> Column:
    """Text of bytes that were read one character a byte."""
    return F.make_valid_utf8(F.encode(latin, "ISO-8859-1").cast("string"))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines of the pairs whose value is not null."""
    return F.concat_ws(CRLF, *[F.concat(F.lit(f"{n}: "), v) for n, v in pairs])


def record(head: Column, block: Column) -> Column:
    """A record without its closing two line ends, which ``save`` writes."""
    return F.concat(F.lit("WARC/1.1" + CRLF), head, F.lit(CRLF + "Content-Length: "),
                    F.octet_length(block).cast("string"), F.lit(BLANK), block)


def responses(pages: DataFrame, key: str, date: str) -> DataFrame:
    """``key`` and ``record``: a response record for each page (url, html)."""
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    block = F.concat(_lines(("HTTP/1.1 200 OK\r\nContent-Type", F.lit("text/html; charset=utf-8")),
                            ("Content-Length", F.octet_length(html).cast("string"))), F.lit(BLANK), html)
    rows = pages.select(key, url.alias("__url"), html.alias("__html"), block.alias("__block"))
    head = _lines(("WARC-Type", F.lit("response")),
                  ("WARC-Record-ID", record_id(F.lit("response"), F.col(key).cast("string"), F.col("__url"))),
                  ("WARC-Target-URI", F.col("__url")), ("WARC-Date", F.lit(date)),
                  ("Content-Type", F.lit("application/http; msgtype=response")),
                  ("WARC-Block-Digest", digest(F.col("__block"))),
                  ("WARC-Payload-Digest", digest(F.col("__html"))))
    return rows.select(key, record(head, F.col("__block")).alias("record"))


def derive(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One or two rows per response record of column ``record`` (text or bytes):
    ``keep``, warc_type, record_id, refers_to, target_uri, concurrent_to,
    source_digest (of the response's payload, as the response has it, or made
    here), block_digest, block and the whole derived ``record``."""
    binary = isinstance(records.schema["record"].dataType, BinaryType)
    mine = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("keep")] if keep else []
    own, theirs = [c for c in ("keep",) if keep], ["keep.*"] if keep else []
    whole = F.decode("record", "ISO-8859-1") if binary else F.col("record")
    head, block = split_head(F.col("whole"))
    parsed = records.select(*mine, whole.alias("whole")).select(
        *own, (_utf8(head) if binary else head).alias("head"), block.alias("http_block"))
    parsed = parsed.where(F.lower(header(F.col("head"), "WARC-Type")) == "response")
    http, payload = split_head(F.col("http_block"))
    of = lambda name: header(F.col("head"), name)
    sent = lambda name: header(F.col("http"), name)
    s = parsed.select(
        *own, of("WARC-Record-ID").alias("id"), of("WARC-Target-URI").alias("uri"), of("WARC-Date").alias("date"),
        of("WARC-Payload-Digest").alias("said"), of("WARC-Block-Digest").alias("block_said"),
        header_lines(F.col("head"), "warc-header: ", CARRIED).alias("others"),
        (_utf8(http) if binary else http).alias("http"), payload.alias("payload"))
    s = s.withColumn("mime", F.lower(sent("Content-Type"))).withColumn("type", F.rtrim(F.substring_index("mime", ";", 1)))
    plain = F.lower(F.coalesce(sent("Content-Encoding"), F.lit("identity"))) == "identity"
    s = s.withColumn("is_text", plain & (F.col("type").isNull() | F.rlike("type", F.lit(TEXT_TYPES))))
    s = s.withColumn("is_html", F.col("is_text") & (F.col("type").isNull() | F.rlike("type", F.lit(TAGGED_TYPES))))
    if binary:
        latin = F.regexp_extract("mime", r"charset=[\"']?([\w-]+)", 1).isin(*LATIN)
        s = s.withColumn("shown", F.when(~F.col("is_text"), "").when(latin, F.translate("payload", *CP1252))
                         .otherwise(_utf8(F.col("payload"))))
        s = s.withColumn("payload", F.encode("payload", "ISO-8859-1"))
    else:
        s = s.withColumn("shown", F.col("payload"))
    tagged = F.when(F.col("is_html"), F.col("shown")).otherwise("")
    s = with_html_text(s.withColumn("html", tagged), "html", "html_text")
    s = with_html_text(s.withColumn("title_html", title_html(F.col("html"))), "title_html", "title")
    s = s.withColumn("text", F.when(F.col("is_html"), F.col("html_text")).when(F.col("is_text"), F.col("shown")))
    s = s.withColumn("text_digest", digest(F.col("text")))
    s = s.withColumn("source_digest", F.coalesce("said", digest(F.col("payload"))))
    conversion = F.when(F.col("is_text"), record_id(F.lit("conversion"), F.coalesce("id", F.lit(""))))
    metadata = record_id(F.lit("metadata"), F.coalesce("id", F.lit("")))
    fields = F.concat_ws(
        CRLF,
        _lines(("title", F.nullif("title", F.lit(""))),
               ("http-status", F.nullif(F.regexp_extract("http", r"^\S+ (\d+)", 1), F.lit(""))),
               ("source-payload-digest", F.col("source_digest")), ("source-block-digest", F.col("block_said")),
               ("text-digest", F.col("text_digest")), ("text-length", F.octet_length("text").cast("string")),
               ("digest-match", digest_match(F.col("said"), F.col("payload")).cast("string"))),
        "others", header_lines(F.col("http"), "http-header: "))
    s = s.withColumn("fields", fields)
    made = F.explode(F.filter(F.array(
        F.struct(F.lit("conversion").alias("warc_type"), conversion.alias("record_id"),
                 F.lit(None).cast("string").alias("concurrent_to"),
                 F.lit("text/plain; charset=utf-8").alias("mime"), F.col("text_digest").alias("digest"),
                 F.col("text").alias("block")),
        F.struct(F.lit("metadata").alias("warc_type"), metadata.alias("record_id"),
                 conversion.alias("concurrent_to"),
                 F.lit("application/warc-fields").alias("mime"), digest(F.col("fields")).alias("digest"),
                 F.col("fields").alias("block"))), lambda r: r["block"].isNotNull()))
    rows = s.select(*own, "id", "uri", "date", "source_digest", made.alias("m")).select(
        *theirs, "m.warc_type", "m.record_id", F.col("id").alias("refers_to"), F.col("uri").alias("target_uri"),
        "m.concurrent_to", "source_digest", F.col("m.digest").alias("block_digest"), "m.block",
        F.col("m.mime").alias("__mime"), F.col("date").alias("__date"))
    head = _lines(("WARC-Type", F.col("warc_type")), ("WARC-Record-ID", F.col("record_id")),
                  ("WARC-Target-URI", F.col("target_uri")), ("WARC-Date", F.col("__date")),
                  ("WARC-Refers-To", F.col("refers_to")), ("WARC-Refers-To-Target-URI", F.col("target_uri")),
                  ("WARC-Refers-To-Date", F.col("__date")), ("WARC-Concurrent-To", F.col("concurrent_to")),
                  ("Content-Type", F.col("__mime")), ("WARC-Block-Digest", F.col("block_digest")))
    return rows.withColumn("record", record(head, F.col("block"))).drop("__mime", "__date")


def save(records: DataFrame, path: str) -> None:
    """Write ``record`` to gzip-compressed WARC files, one per partition: each
    record ends with two line ends, which the text writer sets as separator."""
    records.select("record").write.option("lineSep", BLANK).option("compression", "gzip").text(path)
