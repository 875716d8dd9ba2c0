"""Language identification: text, markup, address and host evidence fused by Bayes' rule."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.spans import let
from millrace.llm.tables import fresh, narrow_broadcast, settle

# Letter triples are counted in this many cells per language.
CELLS = 1 << 14
# Triples overlap, so a text says less than the product of their likelihoods.
TEXT_WEIGHT = 0.3
# Chance that a page declares, or its address ends in, the language it is written in.
DECLARED_TRUST = 0.9
SUFFIX_TRUST = 0.8
# Weight of a parent's prior, in documents, against the counts of a host or site.
SMOOTHING = 5.0
# A text is rejected where its language is less certain than this, or where its mean log
# likelihood per triple is this much below that of its language's own training texts.
LEAST_POSTERIOR = 0.5
MOST_SURPRISE = 3.0

# The codes of ISO 639-1, old ones too, and of ISO 639-2 but for those of no
# one language. Only these are languages, so their number is bounded.
CODES = frozenset((
    "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo "
    "es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik in io is it iu iw ja ji "
    "jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mo mr ms mt my na nb nd "
    "ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg sh si sk sl sm sn so sq sr ss "
    "st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu "
    "aar abk ace ach ada ady afa afh afr ain aka akk alb ale alg alt amh ang anp apa ara arc arg arm arn arp art arw asm "
    "ast ath aus ava ave awa aym aze bad bai bak bal bam ban baq bas bat bej bel bem ben ber bho bih bik bin bis bla bnt "
    "bod bos bra bre btk bua bug bul bur byn cad cai car cat cau ceb cel ces cha chb che chg chi chk chm chn cho chp chr "
    "chu chv chy cmc cnr cop cor cos cpe cpf cpp cre crh crp csb cus cym cze dak dan dar day del den deu dgr din div doi "
    "dra dsb dua dum dut dyu dzo efi egy eka ell elx eng enm epo est eus ewe ewo fan fao fas fat fij fil fin fiu fon fra "
    "fre frm fro frr frs fry ful fur gaa gay gba gem geo ger gez gil gla gle glg glv gmh goh gon gor got grb grc gre grn "
    "gsw guj gwi hai hat hau haw heb her hil him hin hit hmn hmo hrv hsb hun hup hye iba ibo ice ido iii ijo iku ile ilo "
    "ina inc ind ine inh ipk ira iro isl ita jav jbo jpn jpr jrb kaa kab kac kal kam kan kar kas kat kau kaw kaz kbd kha "
    "khi khm kho kik kin kir kmb kok kom kon kor kos kpe krc krl kro kru kua kum kur kut lad lah lam lao lat lav lez lim "
    "lin lit lol loz ltz lua lub lug lui lun luo lus mac mad mag mah mai mak mal man mao map mar mas may mdf mdr men mga "
    "mic min mkd mkh mlg mlt mnc mni mno moh mon mos mri msa mun mus mwl mwr mya myn myv nah nai nap nau nav nbl nde ndo "
    "nds nep new nia nic niu nld nno nob nog non nor nqo nso nub nwc nya nym nyn nyo nzi oci oji ori orm osa oss ota oto "
    "paa pag pal pam pan pap pau peo per phi phn pli pol pon por pra pro pus que raj rap rar roa roh rom ron rum run rup "
    "rus sad sag sah sai sal sam san sas sat scn sco sel sem sga sgn shn sid sin sio sit sla slk slo slv sma sme smi smj "
    "smn smo sms sna snd snk sog som son sot spa sqi srd srn srp srr ssa ssw suk sun sus sux swa swe syc syr tah tai tam "
    "tat tel tem ter tet tgk tgl tha tib tig tir tiv tkl tlh tli tmh tog ton tpi tsi tsn tso tuk tum tup tur tut tvl twi "
    "tyv udm uga uig ukr umb urd uzb vai ven vie vol vot wak wal war was wel wen wln wol xal xho yao yap yid yor ypk zap "
    "zbl zen zgh zha zho znd zul zun zza "
).split())
# Country suffixes that stand for one language (ISO 3166 to ISO 639).
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "ie": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh", "kr": "ko", "se": "sv", "dk": "da", "fi": "fi", "cz": "cs", "tr": "tr", "gr": "el"}


def identify_languages(
    docs: DataFrame,
    text: str = "text",
    declared: str | None = "lang",
    url: str | None = None,
    host: str | None = "source",
) -> DataFrame:
    """The rows of ``docs`` with the struct ``language``.

    Its fields: ``best`` (language, null where there is no evidence at all), ``posterior``
    (of the best), ``surprise`` (how much less likely the text is, per letter triple, than
    training texts of the best language; null without triples), ``triples``, ``accepted``.

    The posterior is the normalised product of
    - the likelihood of the letter triples of the whole text, from counts over all texts,
      grouped by the language that they declare;
    - the chance of the declared markup language (``declared``);
    - that of the language for which the suffix of the address stands (``url``);
    - the prior of the host: its share of declared languages, smoothed towards that of the
      site (the last two labels of the host), and that towards the share of all documents.

    Languages are those of ``CODES`` declared anywhere, in lower case and without region;
    any other declaration is no evidence. A null or empty text, declaration, address or host is no evidence.
    A document without triples is judged by the rest, one without any evidence by the
    prior. Nothing declared anywhere: ``best`` is null and nothing is accepted. Repeated
    rows are each judged, and counted. Columns of ``docs`` stay as they are, except that
    one of the name ``language`` is replaced.
    """
    names = ("text", "declared", "suffix", "host", "text_score", "prior", "prior_host", "language")
    own = {name: fresh(docs.columns, name) for name in names}
    code = _language_code(F.col(f"`{declared}`") if declared else F.lit(None))
    seen = docs.select(
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"), code.alias("_declared"), _host(url, host).alias("_host")
    )
    counts = settle(_triple_counts(seen))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "language"]
    languages, table, usual = _model(counts)
    if not languages:
        nothing = "named_struct('best', CAST(NULL AS STRING), 'posterior', 0D, 'surprise', CAST(NULL AS DOUBLE), 'triples', 0L, 'accepted', false)"
        return docs.select(*kept, F.expr(nothing).alias("language"))
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(table)  # at most CELLS x len(CODES) floats

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def likelihoods(texts: pd.Series) -> pd.Series:
        return pd.Series([_score(t, shipped.value) for t in texts])

    scored = docs.select(
        *kept,
        code.alias(own["declared"]),
        (_suffix_language(F.col(f"`{url}`")) if url else F.lit(None).cast("string")).alias(own["suffix"]),
        _host(url, host).alias(own["host"]),
        likelihoods(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias(own["text_score"]),
    )
    priors, overall = host_priors(seen, languages)
    priors = settle(priors)
    sides = priors.select(F.col("host").alias(own["prior_host"]), F.col("prior").alias(own["prior"]))
    # a prior is a few numbers, and hosts are far fewer than documents
    sides = narrow_broadcast(sides, priors.count() * (1 + len(languages) // 8))
    joined = scored.join(sides, F.col(own["host"]) == F.col(own["prior_host"]), "left")
    return joined.select(*kept, _fused(own, languages, usual, overall).alias("language"))


def _numbers(values) -> str:
    return f"array({', '.join(f'{float(v)!r}D' for v in values)})"


def _fused(own: dict[str, str], languages: list[str], usual: np.ndarray, overall: list[float]) -> Column:
    """The struct of the verdict, from arrays with a number for each language."""
    k = len(languages)
    names = f"array({', '.join(repr(name) for name in languages)})"

    def said(place: str, trust: float) -> str:
        other = (1 - trust) / max(k - 1, 1) + 1e-9
        return f"IF({place} IS NULL OR {place} = 0, 0D, IF({place} = i + 1, {math.log(trust)!r}D, {math.log(other)!r}D))"

    prior = f"coalesce({own['prior']}, {_numbers(overall)})"
    parts = f"zip_with(slice({own['text_score']}, 1, {k}), {prior}, (t, p) -> {TEXT_WEIGHT}D * t + ln(p))"

    def judged(places: str, logs: str, most: str) -> str:
        best = f"CAST(array_position({logs}, {most}) AS int)"
        mass = f"aggregate({logs}, 0D, (a, x) -> a + exp(x - {most}))"
        triples = f"{own['text_score']}[{k}]"
        surprise = f"IF({triples} > 0, {_numbers(usual)}[{best} - 1] - {own['text_score']}[{best} - 1] / {triples}, CAST(NULL AS double))"
        told = f"named_struct('best', {names}[{best} - 1], 'posterior', 1 / {mass}, 'surprise', {surprise}, 'triples', CAST({triples} AS bigint))"
        accepted = f"coalesce(v.posterior >= {LEAST_POSTERIOR}D AND v.triples > 0 AND v.surprise <= {MOST_SURPRISE}D, false)"
        fields = ", ".join(f"'{f}', v.{f}" for f in ("best", "posterior", "surprise", "triples"))
        return f"transform(array({told}), v -> named_struct({fields}, 'accepted', {accepted}))[0]"

    # looked up once, not once per language
    at = f"named_struct('declared', array_position({names}, {own['declared']}), 'suffix', array_position({names}, {own['suffix']}))"

    def fused(places: str) -> str:
        both = f"{said(f'{places}.declared', DECLARED_TRUST)} + {said(f'{places}.suffix', SUFFIX_TRUST)}"
        return let(f"transform({parts}, (x, i) -> x + {both})", lambda logs: let(f"array_max({logs})", lambda most: judged(places, logs, most)))

    return F.expr(let(at, fused))


def host_priors(seen: DataFrame, languages: list[str]) -> tuple[DataFrame, list[float]]:
    """``host, prior``: shares of the declared languages per host, smoothed upwards; and those of
    all documents, which are smoothed by one document of each language.
    """
    rows = seen.where("_declared IS NOT NULL").groupBy(F.coalesce("_host", F.lit("")).alias("host"), "_declared")
    counts = settle(rows.agg(F.count(F.lit(1)).alias("n")))
    # at most as many rows as there are languages
    every = {r["_declared"]: r["n"] for r in counts.groupBy("_declared").agg(F.sum("n").alias("n")).collect()}
    total = [every.get(name, 0) + 1.0 for name in languages]
    overall = [x / sum(total) for x in total]
    names = f"array({', '.join(repr(name) for name in languages)})"

    def shares(level: DataFrame, key: str) -> DataFrame:
        # one entry per language, reduced before the shuffle
        sums = level.groupBy(key, "_declared").agg(F.sum("n").alias("n"))
        return sums.groupBy(key).agg(
            F.map_from_entries(F.collect_list(F.struct("_declared", F.col("n").cast("double")))).alias("ns"), F.sum("n").cast("double").alias("of_all")
        )

    def smoothed(parent: str) -> Column:
        here = f"transform({names}, name -> coalesce(try_element_at(ns, name), 0D))"
        return F.expr(f"zip_with({here}, {parent}, (n, p) -> (n + {SMOOTHING}D * p) / (of_all + {SMOOTHING}D))")

    sites = shares(counts.withColumn("site", _site(F.col("host"))), "site").select("site", smoothed(_numbers(overall)).alias("parent"))
    hosts = shares(counts, "host").where("host <> ''").withColumn("site", _site(F.col("host")))
    return hosts.join(sites, "site").select("host", smoothed("parent").alias("prior")), overall


def _site(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def _host(url: str | None, host: str | None) -> Column:
    named = F.lower(F.col(f"`{host}`")) if host else F.lit(None).cast("string")
    found = F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)) if url else F.lit("")
    return F.nullif(F.coalesce(F.nullif(found, F.lit("")), named), F.lit(""))


def _suffix_language(url: Column) -> Column:
    suffix = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#:]*\.([A-Za-z]+)(?:[:/?#]|$)", 1))
    return F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair])[suffix]


def _language_code(declared: Column) -> Column:
    """``de`` of ``de-AT`` or ``DE_at``; null where no known language is declared."""
    code = F.lower(F.trim(F.regexp_extract(declared.cast("string"), "^[^-_]*", 0)))
    return F.when(code.isin(*sorted(CODES)), code)


def _cells(text: str) -> np.ndarray:
    """The cell of every letter triple; whatever is no letter counts as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = np.where(_letters()[np.minimum(codes, 0xFFFF)], codes, 32)
    if len(letters) > 1:
        letters = letters[np.concatenate(([True], (letters[1:] != 32) | (letters[:-1] != 32)))]
    if len(letters) < 3:
        return np.empty(0, np.int64)
    h = letters[:-2] * np.uint32(0x9E3779B1) + letters[1:-1] * np.uint32(0x85EBCA77) + letters[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    return ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 14)).astype(np.int64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def _score(text: str, table: np.ndarray) -> list[float]:
    """The log likelihood of the triples under each language, then their number."""
    cells = _cells(text)
    there, times = np.unique_counts(cells) if len(cells) < 4 * CELLS else (np.arange(CELLS), np.bincount(cells, minlength=CELLS))
    return [*(table[:, there] @ times.astype(np.float64)).tolist(), float(len(cells))]


def _triple_counts(seen: DataFrame) -> DataFrame:
    """``language, cell, n`` over all texts that declare a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for language, text in zip(part["_declared"].to_pylist(), part["_text"].to_pylist()):
                    if language not in sums:
                        sums[language] = np.zeros(CELLS, np.int64)
                    sums[language] += np.bincount(_cells(text), minlength=CELLS)
        for language, row in sums.items():
            cells = np.append(np.flatnonzero(row), -1)  # a language stays known without any text
            n = np.append(row[cells[:-1]], 0)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(cells)), pa.array(cells), pa.array(n)], ["language", "cell", "n"])

    partial = seen.select("_declared", "_text").where("_declared IS NOT NULL").mapInArrow(run, "language string, cell bigint, n bigint")
    return partial.groupBy("language", "cell").agg(F.sum("n").alias("n"))


def _model(counts: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The languages, the log probability per language and cell, and the mean over each
    language's own texts.

    A task makes the row of a language, ``CELLS`` floats; the rows of all languages, each of
    them in ``CODES``, come here as bytes.
    """

    def of_language(rows: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(CELLS)
        there = rows["cell"] >= 0
        seen[rows.loc[there, "cell"]] = rows.loc[there, "n"]
        logs = np.log((seen + 0.5) / (seen.sum() + 0.5 * CELLS))
        usual = (logs * seen).sum() / max(seen.sum(), 1)
        return pd.DataFrame({"language": rows["language"].iloc[:1], "logs": [logs.astype(np.float32).tobytes()], "usual": [usual]})

    found = counts.groupBy("language").applyInPandas(of_language, "language string, logs binary, usual double").toArrow().sort_by("language")
    logs = [np.frombuffer(x.as_buffer(), np.float32) for x in found["logs"]]
    return found["language"].to_pylist(), np.array(logs).reshape(-1, CELLS), found["usual"].to_numpy()
