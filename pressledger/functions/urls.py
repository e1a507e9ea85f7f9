"""Public-URL rules, link resolution and identity URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .binding import bound
from .text import hygiene_reason

URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
HOST = r"^[a-z0-9](?:[a-z0-9.\-]*[a-z0-9])?$"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{OCTET}(?:\.{OCTET}){{3}}$"

# fixed values: address ranges that are not global, and the global exceptions inside them
PRIVATE_IPV4 = ("0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12",
                "192.0.0.0/24", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24",
                "203.0.113.0/24", "240.0.0.0/4")
GLOBAL_IPV4 = ("192.0.0.9/32", "192.0.0.10/32")
PRIVATE_IPV6 = ("::/127", "64:ff9b:1::/48", "100::/64", "2001::/23", "2001:db8::/32", "2002::/16",
                "fc00::/7", "fe80::/10")
GLOBAL_IPV6 = ("2001:1::1/128", "2001:1::2/128", "2001:3::/32", "2001:4:112::/48", "2001:20::/28", "2001:30::/28")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, URL, 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, URL, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(url, URL, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, URL, 4)


def host_port(url: Column) -> Column:
    return F.regexp_extract(authority(url), r"([^@]*)$", 1)


def host(url: Column) -> Column:
    """Lower-case host without its port and trailing dots; IPv6 keeps its brackets."""
    return F.rtrim(F.lower(F.regexp_extract(host_port(url), r"^(\[[^\]]*\]|[^:\[\]]*)", 1)), F.lit("."))


def origin(url: Column) -> Column:
    parts = F.struct(scheme(url).alias("scheme"), F.lower(host_port(url)).alias("where"))

    def text(p: Column) -> Column:
        default = F.when(p["scheme"] == "http", ":80$").when(p["scheme"] == "https", ":443$").otherwise(":$")
        return F.concat(p["scheme"], F.lit("://"), F.regexp_replace(F.regexp_replace(p["where"], default, ""), ":$", ""))

    return bound(parts, text)


def _in_ranges(number: Column, networks: tuple[str, ...], width: int) -> Column:
    from ipaddress import ip_network
    hit = F.lit(False)
    for text in networks:
        net = ip_network(text)
        first, last = int(net.network_address), int(net.broadcast_address)
        if width == 32:
            hit = hit | number.between(first, last)
        else:  # 128 bits are compared as 32 hex digits
            hit = hit | number.between(f"{first:032x}", f"{last:032x}")
    return hit


def _ipv4_number(text: Column) -> Column:
    parts = F.split(text, r"\.")
    return sum((F.try_element_at(parts, F.lit(i + 1)).try_cast("bigint") * (1 << (24 - 8 * i)) for i in range(4)), F.lit(0))


def _ipv4_global(number: Column) -> Column:
    return ~_in_ranges(number, PRIVATE_IPV4, 32) | _in_ranges(number, GLOBAL_IPV4, 32)


def ipv4_is_global(text: Column) -> Column:
    return bound(_ipv4_number(text), _ipv4_global)


def _without_ipv4_tail(text: Column) -> Column:
    """The last 32 bits as two groups; NULL when a dotted tail is no IPv4 address."""
    def spelled(tail: Column) -> Column:
        digits = F.lpad(F.lower(F.hex(_ipv4_number(tail))), 8, "0")
        return F.concat(F.regexp_replace(text, r"[0-9]+\.[0-9.]+$", ""),
                        bound(digits, lambda d: F.concat(F.substring(d, 1, 4), F.lit(":"), F.substring(d, 5, 4))))

    return bound(F.regexp_extract(text, r":([0-9]+\.[0-9.]+)$", 1), lambda tail: F.when(tail == "", text).when(
        tail.rlike(IPV4), spelled(tail)))


def ipv6_digits(text: Column) -> Column:
    """An IPv6 literal (no brackets) as 32 hex digits, or NULL when malformed."""
    def groups(half: Column) -> Column:
        return F.filter(F.split(half, ":"), lambda g: g != "")

    def sides(plain: Column) -> Column:
        halves = F.split(plain, "::")
        return F.struct(plain.alias("plain"), F.size(halves).alias("halves"), groups(halves[0]).alias("left"),
                        groups(F.coalesce(F.get(halves, F.lit(1)), F.lit(""))).alias("right"))

    def digits(s: Column) -> Column:
        known = F.size(s["left"]) + F.size(s["right"])
        filled = F.concat(s["left"], F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - known)), s["right"])
        valid = (F.when(s["halves"] == 2, known <= 7).otherwise((s["halves"] == 1) & (known == 8))
                 & ~s["plain"].rlike("^:[^:]|[^:]:$|:::")
                 & F.forall(F.concat(s["left"], s["right"]), lambda g: g.rlike("^[0-9a-f]{1,4}$")))
        return F.when(valid, F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), ""))

    return bound(bound(_without_ipv4_tail(text), sides), digits)


def ipv6_is_global(text: Column) -> Column:
    def verdict(digits: Column) -> Column:
        mapped = bound(F.conv(F.substring(digits, 25, 8), 16, 10).try_cast("bigint"), _ipv4_global)
        return F.when(digits.startswith("00000000000000000000ffff"), mapped).otherwise(
            ~_in_ranges(digits, PRIVATE_IPV6, 128) | _in_ranges(digits, GLOBAL_IPV6, 128))

    return F.coalesce(bound(ipv6_digits(text), verdict), F.lit(False))


def public_url_reason(url: Column) -> Column:
    """First broken rule, NULL for an acceptable public URL."""
    parts = F.struct(
        url.alias("url"), scheme(url).alias("scheme"), host(url).alias("host"), query(url).alias("query"),
        F.regexp_extract(authority(url), r"^(.*)@", 1).alias("userinfo"),
        F.regexp_extract(host_port(url), r"^(?:\[[^\]]*\]|[^:\[\]]*):?(.*)$", 1).alias("port"))

    def first_broken(p: Column) -> Column:
        name, port = p["host"], p["port"]
        bracketed, dotted = name.startswith("["), name.rlike(IPV4)
        named = (name.rlike(HOST) & name.contains(".") & ~name.rlike("^[0-9.xa-f]*$")
                 & ~_ends_with_any(name, rules.RESERVED_SUFFIXES))
        keys = F.transform(
            F.filter(F.split(p["query"], "&"), lambda q: q.rlike("^[^=]*=.")),
            lambda q: F.regexp_replace(F.regexp_extract(q, "^([^=]*)=", 1), r"\+", " "))
        secret = F.exists(keys, lambda k: F.coalesce(F.try_url_decode(k), k).rlike(rules.AUTH_PARAMETER))
        return (F.when(hygiene_reason(p["url"], 2048).isNotNull(), "text")
                .when(p["url"].rlike(r"(?U)[\s\\<>]"), "characters")
                .when(~p["scheme"].isin("http", "https"), "scheme")
                .when(~p["userinfo"].isin("", ":"), "credentials")
                .when((port != "") & ~F.coalesce(port.try_cast("int").isin(80, 443), F.lit(False)), "port")
                .when(bracketed & ~ipv6_is_global(F.regexp_extract(name, r"^\[(.*)\]$", 1)), "address")
                .when(~bracketed & dotted & ~F.coalesce(ipv4_is_global(name), F.lit(False)), "address")
                .when(~bracketed & ~dotted & ~named, "host")
                .when(secret, "auth_parameter"))

    return bound(parts, first_broken)


def _ends_with_any(text: Column, suffixes: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for suffix in suffixes:
        hit = hit | text.endswith(suffix)
    return hit


def resolve(base: Column, reference: Column) -> Column:
    """A reference against an absolute base URL, fragment dropped, dot segments removed."""
    parts = F.struct(
        F.regexp_replace(reference, "#.*$", "").alias("ref"), scheme(base).alias("scheme"),
        authority(base).alias("authority"), path(base).alias("path"), query(base).alias("query"))

    def absolute(p: Column) -> Column:
        ref, folder = p["ref"], F.regexp_extract(p["path"], r"^(.*/)[^/]*$", 1)
        search = F.when(p["query"] == "", "").otherwise(F.concat(F.lit("?"), p["query"]))
        rest = (F.when(ref.startswith("/"), ref)
                .when(ref.startswith("?"), F.concat(F.when(p["path"] == "", "/").otherwise(p["path"]), ref))
                .when(ref == "", F.concat(p["path"], search))
                .otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), ref)))
        return (F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), ref)
                .when(ref.startswith("//"), F.concat(p["scheme"], F.lit(":"), ref))
                .otherwise(F.concat(p["scheme"], F.lit("://"), p["authority"], rest)))

    def split_up(url: Column) -> Column:
        return F.struct(F.regexp_extract(url, r"^([^/]*//[^/?]*)", 1).alias("root"), path(url).alias("path"),
                        F.regexp_extract(url, r"^[^?]*(\?.*)$", 1).alias("search"))

    def without_dots(where: Column) -> Column:
        kept = F.aggregate(
            F.split(F.substr(where, F.lit(2)), "/"), F.array().cast("array<string>"),
            lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
            .when(s == ".", done).otherwise(F.concat(done, F.array(s))))
        return F.concat(F.lit("/"), F.array_join(kept, "/"),
                        F.when(where.rlike(r"/\.{1,2}$") & (F.size(kept) > 0), "/").otherwise(""))

    def tidy(u: Column) -> Column:
        where = (F.when(u["path"] == "", "/").when(u["path"].rlike(r"/\.{1,2}(?:/|$)"), without_dots(u["path"]))
                 .otherwise(u["path"]))
        return F.concat(u["root"], where, u["search"])

    return bound(bound(bound(parts, absolute), split_up), tidy)
