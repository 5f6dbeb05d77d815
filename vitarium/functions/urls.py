"""URL functions: resolution against a base, record keys, index pages."""

from __future__ import annotations

import re
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitarium.fixed import INDEX_PATH_START
from vitarium.functions.text import first_truthy, normalize_text

DEFAULT_PORTS = {"http": "80", "https": "443", "ws": "80", "wss": "443", "ftp": "21"}
_PRINTABLE = "".join(chr(p) for p in range(0x21, 0x7F))
# Characters each part of a URL keeps as they are; the rest is percent-encoded.
_KEEP_PATH = "".join(c for c in _PRINTABLE if c not in '"#<>?^`{}')
_KEEP_QUERY = "".join(c for c in _PRINTABLE if c not in "\"#<>'")
_KEEP_FRAGMENT = "".join(c for c in _PRINTABLE if c not in '"<>`')
_KEEP_USER = "".join(c for c in _PRINTABLE if c not in '"#<>?`{}/:;=@[\\]^|')
_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(.*)", re.S)
_DOT, _DOTS = {".", "%2e"}, {"..", ".%2e", "%2e.", "%2e%2e"}


def _tidy(text: str) -> str:
    ends = "".join(map(chr, range(0x21)))
    return re.sub(r"[\t\n\r]", "", text.strip(ends))


def _dotless(path: str) -> str:
    kept: list[str] = []
    segments = path.split("/")[1:]
    for place, segment in enumerate(segments):
        last = place == len(segments) - 1
        if segment.lower() in _DOTS:
            kept = kept[:-1] + ([""] if last else [])
        elif segment.lower() in _DOT:
            kept += [""] if last else []
        else:
            kept.append(segment)
    return "/" + "/".join(kept)


def _host(scheme: str, netloc: str) -> str:
    user, _, place = netloc.rpartition("@")
    if place.startswith("["):
        end = place.index("]") + 1
        host, (before, _, port) = place[:end], place[end:].partition(":")
        if before:
            raise ValueError("no usable host")
    else:
        host, _, port = place.partition(":")
    if not host.isascii():
        host = host.encode("idna").decode("ascii")
    host = host.lower()
    if not host or (host[0] != "[" and re.search(r"[\s#%/:<>?@\\^|\[\]]", host)):
        raise ValueError("no usable host")
    if port and not (port.isdigit() and int(port) < 65536):
        raise ValueError("bad port")
    port = str(int(port)) if port else ""
    login = ":".join(quote(p, safe=_KEEP_USER) for p in user.split(":", 1)) + "@" if user else ""
    return login + host + (f":{port}" if port and port != DEFAULT_PORTS[scheme] else "")


def resolve_url(base: str | None, href: str | None) -> str | None:
    """``href`` seen from ``base`` the way a browser resolves it; None if it cannot be."""
    if href is None:
        return None
    try:
        return _resolve(_tidy(base or ""), _tidy(href))
    except (ValueError, UnicodeError):
        return None


def _resolve(base: str, href: str) -> str | None:
    named = _SCHEME.fullmatch(href)
    scheme = named.group(1).lower() if named else ""
    if named and scheme not in DEFAULT_PORTS:
        return f"{scheme}:" + quote(named.group(2), safe=_PRINTABLE + " ")
    base_named = _SCHEME.fullmatch(base)
    base_scheme = base_named.group(1).lower() if base_named else ""
    rest = named.group(2) if named else href
    rest, hash_mark, fragment = rest.partition("#")
    rest, query_mark, query = rest.partition("?")
    rest = rest.replace("\\", "/")
    if named and (scheme != base_scheme or rest.startswith("/")):
        slashes = len(rest) - len(rest.lstrip("/"))
        if scheme != base_scheme or slashes > 1:
            netloc, _, path = rest.lstrip("/").partition("/")
            origin, path = f"{scheme}://{_host(scheme, netloc)}", "/" + path
            return _assemble(origin, path, query_mark, query, hash_mark, fragment)
    if base_scheme not in DEFAULT_PORTS:
        return None
    seen = urlsplit(base)
    origin = f"{base_scheme}://{_host(base_scheme, seen.netloc)}"
    path = rest
    if rest.startswith("//"):
        netloc, _, path = rest.lstrip("/").partition("/")
        origin, path = f"{base_scheme}://{_host(base_scheme, netloc)}", "/" + path
    elif not rest:
        path = seen.path or "/"
        if not query_mark and "?" in base.split("#")[0]:
            query_mark, query = "?", seen.query
    elif not rest.startswith("/"):
        path = (seen.path or "/").rpartition("/")[0] + "/" + rest
    return _assemble(origin, path, query_mark, query, hash_mark, fragment)


def _assemble(origin: str, path: str, query_mark: str, query: str, hash_mark: str, fragment: str) -> str:
    return (
        origin
        + quote(_dotless(path), safe=_KEEP_PATH)
        + query_mark + quote(query, safe=_KEEP_QUERY)
        + hash_mark + quote(fragment, safe=_KEEP_FRAGMENT)
    )


# --- the same as Spark expressions ---------------------------------------------
_HREF = r"(?s)^([^?#]*)(?:(\?)([^#]*))?(?:(#)(.*))?$"
_BASE = r"(?s)^[A-Za-z][A-Za-z0-9+.-]*:(?://([^/?#]*))?([^?#]*)(?:(\?)([^#]*))?(?:#.*)?$"
_NETLOC = r"(?s)^(?:(.*)@)?(\[[^\]]*\]|[^:\[]?[^:]*)(?::(.*))?$"


def _class_of(safe: str) -> str:
    return "[" + "".join("\\" + c if not c.isalnum() else c for c in safe) + "]"


def _encoded(text: Column, safe: str) -> Column:
    """Percent-encoding of the characters outside ``safe``; most texts have none and are left alone."""
    def character(c: Column) -> Column:
        return F.when(c.rlike(f"^{_class_of(safe)}$"), c).otherwise(
            F.regexp_replace(F.hex(F.encode(c, "utf-8")), F.lit("(..)"), F.lit("%$1")))

    characters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.when(text.rlike(f"^{_class_of(safe)}*$"), text).otherwise(F.array_join(F.transform(characters, character), ""))


def _without_dots(path: Column) -> Column:
    """Dot segments of a path that begins with a slash, removed by a fold over its segments."""
    segments = F.slice(F.split(path, "/"), F.lit(2), F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))

    def kind(segment: Column) -> Column:
        low = F.lower(segment)
        return F.when(low.isin(sorted(_DOTS)), 2).when(low.isin(sorted(_DOT)), 1).otherwise(0)

    # a path that ends in dots ends in a slash
    whole = F.when(kind(F.element_at(segments, -1)) > 0, F.concat(segments, F.array(F.lit("")))).otherwise(segments)
    kept = F.aggregate(whole, F.array().cast("array<string>"), lambda done, segment: (
        F.when(kind(segment) == 2, F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(kind(segment) == 1, done).otherwise(F.concat(done, F.array(segment)))))
    return F.when(path.rlike(r"(?i)/(\.|%2e)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def _origin(scheme: Column, netloc: Column) -> Column:
    """Scheme, login, host and port; NULL if one of them is no good, or the host is not ASCII."""
    user, host, port = (F.regexp_extract(netloc, _NETLOC, k) for k in (1, 2, 3))
    low = F.lower(host)
    fine = (low.rlike(r"^[\x21-\x7E]+$") & (low.startswith("[") | ~low.rlike(r"[\s#%/:<>?@\\^|\[\]]"))
            & (~low.startswith("[") | netloc.rlike(r"\](:.*)?$"))
            & ((port == "") | port.rlike("^[0-9]{1,9}$") & (port.try_cast("int") < 65536)))
    number = port.try_cast("int").cast("string")
    default = F.create_map(*(F.lit(x) for pair in DEFAULT_PORTS.items() for x in pair))[scheme]
    name, colon, word = (F.regexp_extract(user, r"(?s)^([^:]*)(:?)(.*)$", k) for k in (1, 2, 3))
    login = F.when(user == "", "").otherwise(F.concat(_encoded(name, _KEEP_USER), colon, _encoded(word, _KEEP_USER), F.lit("@")))
    return F.when(fine, F.concat(scheme, F.lit("://"), login, low, F.when(
        (port != "") & (number != default), F.concat(F.lit(":"), number)).otherwise("")))


def _native_url(base: Column, href: Column) -> Column:
    """:func:`resolve_url` for hosts in ASCII, step by step as there; others give NULL."""
    def tidy(c: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\n\r]", "")

    base, href = tidy(F.coalesce(base, F.lit(""))), tidy(href)
    pattern = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*):(.*)$"
    web = sorted(DEFAULT_PORTS)
    scheme, base_scheme = (F.lower(F.regexp_extract(c, pattern, 1)) for c in (href, base))
    named = scheme != ""
    rest = F.when(named, F.regexp_extract(href, pattern, 2)).otherwise(href)
    way, query_mark, query, hash_mark, fragment = (F.regexp_extract(rest, _HREF, k) for k in range(1, 6))
    way = F.translate(way, "\\", "/")
    base_netloc, base_way, base_mark, base_query = (F.regexp_extract(base, _BASE, k) for k in range(1, 5))
    base_way = F.when(base_way == "", "/").otherwise(base_way)
    netloc, below = (F.regexp_extract(way, r"(?s)^/*([^/]*)/?(.*)$", k) for k in (1, 2))
    below = F.concat(F.lit("/"), below)

    def assembled(origin: Column, path: Column, mark: Column = query_mark, asked: Column = query) -> Column:
        return F.concat(origin, _encoded(_without_dots(path), _KEEP_PATH), mark, _encoded(asked, _KEEP_QUERY),
                        hash_mark, _encoded(fragment, _KEEP_FRAGMENT))

    own = _origin(base_scheme, base_netloc)
    takes_query = (query_mark == "") & (base_mark != "")
    return (
        F.when(named & ~scheme.isin(web), F.concat(scheme, F.lit(":"), _encoded(F.regexp_extract(href, pattern, 2), _PRINTABLE + " ")))
        .when(named & ((scheme != base_scheme) | way.startswith("//")), assembled(_origin(scheme, netloc), below))
        .when(~base_scheme.isin(web), F.lit(None).cast("string"))
        .when(own.isNull(), F.lit(None).cast("string"))
        .when(way.startswith("//"), assembled(_origin(base_scheme, netloc), below))
        .when(way == "", assembled(own, base_way, F.when(takes_query, "?").otherwise(query_mark),
                                   F.when(takes_query, base_query).otherwise(query)))
        .when(way.startswith("/"), assembled(own, way))
        .otherwise(assembled(own, F.concat(F.regexp_extract(base_way, r"(?s)^(.*)/", 1), F.lit("/"), way)))
    )


@F.pandas_udf(T.StringType())
def _any_host(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([resolve_url(b, h) for b, h in zip(base, href)], dtype=object)


def absolute_url(base: Column | str, href: Column | str, *, unicode_hosts: bool = False) -> Column:
    """Column form of :func:`resolve_url`, all in Spark expressions; an unusable pair gives NULL.

    So does a host outside ASCII, unless ``unicode_hosts``: then pairs with any character beyond ASCII go through a Python
    step, which knows how such hosts are written.
    """
    base, href = (F.col(c) if isinstance(c, str) else c for c in (base, href))
    native = _native_url(base, href)
    if not unicode_hosts:
        return native
    plain = ~F.concat_ws("", base, href).rlike(r"[^\x00-\x7F]")
    return F.when(plain, native).otherwise(_any_host(F.when(~plain, base), F.when(~plain, href)))


def record_key(url: Column, biography_url: Column, name: Column) -> Column:
    """Key of a record: the first non-empty of its URLs and name, normalised, lower case.

    A value of white space only counts as non-empty here and gives an empty key.
    """
    return F.lower(normalize_text(first_truthy(url, biography_url, name)))


def with_record_key(df: DataFrame, alias: str = "record_key") -> DataFrame:
    """Adds the key; columns a table lacks count as empty."""
    parts = [F.col(c) if c in df.columns else F.lit(None).cast("string")
             for c in ("url", "biography_url", "name")]
    return df.withColumn(alias, record_key(*parts))


def encode_component(c: Column | str) -> Column:
    """Percent-encoding of everything but ``A-Z a-z 0-9 - _ . ! ~ * ' ( )``."""
    encoded = F.url_encode(F.col(c) if isinstance(c, str) else c)
    for given, wanted in [("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")]:
        encoded = F.replace(encoded, F.lit(given), F.lit(wanted))
    return encoded


def index_urls(initials: DataFrame, base_url: str, initial: str = "initial",
               alias: str = "index_url") -> DataFrame:
    """One index page per initial: the base URL with its ``Initial,...`` segment
    exchanged, or the standard index path below the base if it has none."""
    encoded = encode_component(initial)
    if re.search(r"Initial,[^/]+", base_url, re.I):
        url = F.regexp_replace(F.lit(base_url), F.lit(r"(?is)^(.*?)Initial,[^/]+"),
                               F.concat(F.lit("$1Initial,"), encoded))
    else:
        # the path holds only ASCII after encoding, so the origin of the base is enough
        root = resolve_url(base_url, INDEX_PATH_START)
        url = F.concat(F.lit(root), encoded, F.lit("/"))
    return initials.withColumn(alias, url)
