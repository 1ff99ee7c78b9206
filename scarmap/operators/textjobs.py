"""Text jobs: tables in pages, map legends, the audit of what is to be published."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.functions.labels import number_in
from scarmap.shared import written

# The patterns of the audit, the tables and the legends, and their labels.
SECRETS = (
    (r"""(?i)\b[A-Za-z0-9_-]*(?:api[_-]?key|apikey|map_key|secret|passwd|password)["' ]*[:=]["' ]*[A-Za-z0-9_\-]{12,}""", "secret nommé avec valeur"),
    (r"\b(?:ghp|gho|ghs|github_pat)_[A-Za-z0-9_]{20,}", "jeton GitHub"),
    (r"\bAKIA[0-9A-Z]{16}\b", "clé d'accès AWS"),
    (r"\bsk-[A-Za-z0-9]{20,}", "clé de type OpenAI"),
    (r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----", "clé privée"),
    (r"\bBearer\s+[A-Za-z0-9._\-]{20,}", "jeton Bearer"),
)
LOCAL_PATH, EMAIL = r"/(?:Users|home)/[A-Za-z0-9._-]+/", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
EXEMPT = ("ems-copernicus.eu", "example.")
LOADS = (r"""\bsrc=["'](https?://([A-Za-z0-9.-]+)[^"']*)""", r"""(?i)<link\b[^>]*?\bhref=["'](https?://([A-Za-z0-9.-]+)[^"']*)""")
ALLOWED = ("data.geopf.fr",)
LEGEND = {
    "image_post": r"(?s)Post-event image:\s*(.+?)(?=Pre-event image:|Base vector layers:|$)",
    "image_pre": r"(?s)Pre-event image:\s*(.+?)(?=Post-event image:|Base vector layers:|$)",
    "situation": r"Situation as of\s+(\d{2}/\d{2}/\d{4}(?:\s+\d{2}:\d{2})?)",
    "evenement": r"Event\s+(\d{2}/\d{2}/\d{4}\s+\d{2}:\d{2})",
    "production": r"Map production\s+(\d{2}/\d{2}/\d{4})",
    "echelle": r"scale of analysis is\s*(1:\d+)",
    "mmu": r"minimum mapping unit \(MMU\) is\s*([\d\s]+sq m)",
    "rmse": r"geometric accuracy\s*\(RMSE\) is\s*(.+?)[,.]",
}
CAVEATS = (
    (r"(?i)delineation is not complete", "délimitation incomplète"),
    (r"(?i)dense smoke", "fumée dense"),
    (r"(?i)cloud cover(?:age)? (?:in|over) (?:the )?[Aa]o[Ii]", "couverture nuageuse en AOI"),
    (r"(?i)could not be analysed", "zones non analysées"),
    (r"(?i)cumulates all burnt area extents", "cumule les produits précédents"),
    (r"(?i)fire (?:was |is )?still (?:active|ongoing|really dynamic)", "feu encore actif"),
)
IMAGE_DATE = r"acquired on\s*(\d{2}/\d{2}/\d{4}(?:\s*at\s*\d{2}:\d{2})?)"
SENSOR = (
    r"(?i)(SPOT[-\s]?\d(?:/\d)?|Sentinel[-\s]?\d[AB]?|Pl[ée]iades(?:-1A/B)?|Landsat[-\s]?\d(?:/\d)?"
    r"|WorldView[-\s]?\d?|GeoEye[-\s]?\d?|PlanetScope|Kompsat[-\s]?\d?)"
)
# Rows and cells of the declared-fire tables.
TABLE_ROW, TABLE_CELL = r"(?s)<tr[^>]*>(.*?)</tr>", r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"
#: Known secrets in one automaton.
KNOWN_AT_ONCE = 100_000
#: Characters of a piece of a long file.
PIECE_CHARS = 4096
OUTPUTS, MOST_BYTES = ("index.html", "data/feux.geojson"), 25_000_000


def plain(html: Column) -> Column:
    """Markup without its tags, white space runs as one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"<[^>]+>", ""), r"\s+", " "))


def table_rows(pages: DataFrame) -> DataFrame:
    """OP-T1: the records of the tables in ``pages(page_id, html)``: rows of seven cells or more
    whose third is a number."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(TABLE_ROW))).alias("n", "tr"))
    cells = rows.select("page_id", "n", F.transform(F.regexp_extract_all("tr", F.lit(TABLE_CELL)), plain).alias("c"))
    cell = lambda i: F.get("c", F.lit(i))
    return cells.where((F.size("c") >= 7) & F.coalesce(cell(2).rlike(r"^\d+$"), F.lit(False))).select(
        "page_id",
        "n",
        cell(2).alias("annee"),
        cell(3).alias("alerte"),
        cell(4).alias("departement"),
        F.trim(F.regexp_replace(cell(5), r"\s*INSEE.*$", "")).alias("commune"),
        F.regexp_extract(cell(5), r"INSEE\s*:\s*(\w+)", 1).alias("insee"),
        number_in(cell(6)).alias("surface_ha"),
        cell(6).alias("detail_surface"),
        F.coalesce(cell(7), F.lit("")).alias("nature"),
        F.coalesce(cell(8), F.lit("")).alias("precision"),
    )


def incomplete_pages(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """OP-T2: ``(page_id, announced, n_read, incomplete)``; unannounced totals are null."""
    said = F.replace(F.regexp_extract("html", r"(?i)(\d[\d\s]*)\s*incendies?", 1), F.lit(" "), F.lit(""))
    read = rows.groupBy("page_id").agg(F.count("*").alias("n_read"))
    out = pages.select("page_id", said.try_cast("int").alias("announced")).join(read, "page_id", "left").fillna(0, ["n_read"])
    return out.withColumn("incomplete", F.coalesce(F.col("announced") > F.col("n_read"), F.lit(False)))


def legends(texts: DataFrame) -> DataFrame:
    """OP-T3: image context of map legends ``(produit, text)``."""
    flat = texts.select("produit", F.regexp_replace("text", r"\s+", " ").alias("t"))
    first = lambda p: F.substring(F.trim(F.regexp_replace(F.regexp_extract("t", p, 1), r"\s+", " ")), 1, 400)
    found = flat.select("produit", "t", *[first(p).alias(k) for k, p in LEGEND.items()])

    def sensors(blob: str) -> Column:
        names = F.regexp_extract_all(F.substring(blob, 1, 160), F.lit(SENSOR), 1)
        return F.array_join(F.array_sort(F.array_distinct(F.transform(names, lambda s: F.replace(s, F.lit(" "), F.lit("-"))))), " + ")

    def dates(blob: str) -> Column:
        return F.array_join(F.transform(F.regexp_extract_all(blob, F.lit(IMAGE_DATE), 1), lambda d: F.regexp_replace(d, r"\s*at\s*", " ")), " ; ")

    notes = F.array_compact(F.array(*[F.when(F.col("t").rlike(p), label) for p, label in CAVEATS]))
    plain_fields = [k for k in LEGEND if not k.startswith("image")]
    return found.select("produit", *plain_fields, *[e for slot in ("image_post", "image_pre") for e in (sensors(slot).alias(f"{slot}_capteur"), dates(slot).alias(f"{slot}_dates"))], F.array_join(notes, " ; ").alias("reserves"))


def _hits(files: DataFrame, rules: list[Column]) -> DataFrame:
    return files.select("path", F.explode(F.array_compact(F.array(*rules))).alias("h")).select("path", "h.rule", "h.level", "h.excerpt")


def _rule(pattern: str, label: str) -> Column:
    hit = F.regexp_extract("content", pattern, 0)
    return F.when(hit != "", F.struct(F.lit(label).alias("rule"), F.lit("error").alias("level"), F.substring(hit, 1, 60).alias("excerpt")))


def scan_secrets(files: DataFrame) -> DataFrame:
    """OP-T4: ``(path, rule, level, excerpt)``: the first hit of each secret pattern in each file."""
    return _hits(files, [_rule(p, label) for p, label in SECRETS])


def scan_identity(files: DataFrame, all_hits: bool = False) -> DataFrame:
    """OP-T5: local paths and e-mail addresses. An address is passed over if the file's first one
    is a producer's; ``all_hits`` looks for the first that isn't."""
    found = F.regexp_extract_all("content", F.lit(EMAIL), 0) if all_hits else F.array(F.regexp_extract("content", EMAIL, 0))
    theirs = lambda x: (x == "") | x.contains(EXEMPT[0]) | x.contains(EXEMPT[1])
    hit = F.get(F.filter(found, lambda x: ~theirs(x)), F.lit(0))
    email = F.when(hit.isNotNull(), F.struct(F.lit("adresse courriel").alias("rule"), F.lit("error").alias("level"), F.substring(hit, 1, 60).alias("excerpt")))
    return _hits(files, [_rule(LOCAL_PATH, "chemin local absolu"), email])


def scan_known(files: DataFrame, secrets: DataFrame, least: int = 8, at_once: int = KNOWN_AT_ONCE) -> DataFrame:
    """OP-T6: ``(path, name)`` of files ``(path, content)`` that hold a known secret ``(name,
    value)`` of ``least`` characters or more.

    Up to ``at_once`` values are broadcast as one Aho-Corasick automaton for each task. More never
    leave the executors: files and values meet by an equi-join on hashes of ``least`` characters,
    those that a value begins with and those at each place of a file, and what meets is looked at.
    Either way a file is read through once. Null contents and values match nothing; a value of
    several names gives a row for each.
    """
    known = written(secrets.where(F.length("value") >= least).select("name", "value"), "known")
    values = known.select("value").distinct()
    if values.limit(at_once + 1).count() > at_once:
        return _met_by_anchor(files, values, least).join(known, "value").select("path", "name")
    shared = files.sparkSession.sparkContext.broadcast([r["value"] for r in values.collect()])

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for v in shared.value:
            automaton.add_word(v, v)
        automaton.make_automaton()
        for batch in batches:
            hits = [(p, v) for p, c in zip(batch["path"], batch["content"], strict=True) if c and shared.value for v in {v for _, v in automaton.iter(c)}]
            yield pd.DataFrame(hits, columns=["path", "value"])

    return files.select("path", "content").mapInPandas(found, "path string, value string").join(known, "value").select("path", "name")


def _met_by_anchor(files: DataFrame, values: DataFrame, least: int) -> DataFrame:
    """``(path, value)`` of files and the values that they hold, by hashes of ``least`` characters;
    long contents are cut into pieces that overlap by one less."""
    starts = F.sequence(F.lit(1), F.greatest(F.length("content") - least + 1, F.lit(1)), F.lit(PIECE_CHARS))
    pieces = files.where(F.length("content") >= least).select("path", F.explode(F.transform(starts, lambda i: F.col("content").substr(i, F.lit(PIECE_CHARS + least - 1)))).alias("piece"))
    places = F.sequence(F.lit(1), F.length("piece") - least + 1)
    anchors = F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.col("piece").substr(i, F.lit(least)))))
    at = pieces.where(F.length("piece") >= least).select("path", F.explode(anchors).alias("anchor"))
    begin = values.select("value", F.xxhash64(F.substring("value", 1, least)).alias("anchor"))
    met = at.join(begin, "anchor").select("path", "value").distinct()
    return files.select("path", "content").join(met, "path").where(F.col("content").contains(F.col("value"))).select("path", "value")


def scan_loads(pages: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """OP-T7: what pages fetch from other domains (errors) and, per domain, what they only cite
    (alerts): ``(path, rule, level, excerpt)``."""
    urls = F.concat(*[F.regexp_extract_all("content", F.lit(p), 1) for p in LOADS])
    loads = pages.select("path", F.explode(urls).alias("url")).withColumn("domain", F.regexp_extract("url", r"https?://([A-Za-z0-9.-]+)", 1))
    errors = loads.where(~F.col("domain").isin(*allowed)).select("path", F.lit("ressource tierce").alias("rule"), F.lit("error").alias("level"), F.substring("url", 1, 70).alias("excerpt"))
    cited = pages.select(F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit(r"https?://([A-Za-z0-9.-]+)"), 1))).alias("excerpt")).distinct()
    alerts = cited.where(~F.col("excerpt").isin(*allowed)).select(F.lit("").alias("path"), F.lit("domaine cité").alias("rule"), F.lit("alert").alias("level"), "excerpt")
    return errors.unionByName(alerts)


def completeness(files: DataFrame, n_features: DataFrame) -> DataFrame:
    """OP-T8: one row: the checks of ``files(path, bytes)`` and of the number of features ``n``."""
    has = lambda name: F.count_if(F.col("path") == name) > 0
    of = files.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), *[has(o).alias(f"has_{i}") for i, o in enumerate(OUTPUTS)])
    total = n_features.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_features"))
    out = of.join(total, F.lit(True))
    whole = (F.col("n_files") > 0) & F.col("has_0") & F.col("has_1")
    return out.select("n_files", "bytes", "n_features", (F.col("bytes") > MOST_BYTES).alias("too_large"), (F.col("n_features") == 0).alias("empty"), whole.alias("passes"))
