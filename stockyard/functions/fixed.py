"""These must equal the published codes and labels, so they are written out as they stand."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values. Brazilian states: code, name, macro-region, region code, centroid latitude, centroid longitude,
# two-digit numeric code.
STATES = [
    ("AC", "Acre", "Norte", "N", -9.0238, -70.8120, "12"),
    ("AL", "Alagoas", "Nordeste", "NE", -9.5713, -36.7820, "27"),
    ("AM", "Amazonas", "Norte", "N", -3.4168, -65.8561, "13"),
    ("AP", "Amapá", "Norte", "N", 1.4100, -51.7700, "16"),
    ("BA", "Bahia", "Nordeste", "NE", -12.5797, -41.7007, "29"),
    ("CE", "Ceará", "Nordeste", "NE", -5.4984, -39.3206, "23"),
    ("DF", "Distrito Federal", "Centro-Oeste", "CO", -15.7801, -47.9292, "53"),
    ("ES", "Espírito Santo", "Sudeste", "SE", -19.1834, -40.3089, "32"),
    ("GO", "Goiás", "Centro-Oeste", "CO", -15.8270, -49.8362, "52"),
    ("MA", "Maranhão", "Nordeste", "NE", -4.9609, -45.2744, "21"),
    ("MG", "Minas Gerais", "Sudeste", "SE", -18.5122, -44.5550, "31"),
    ("MS", "Mato Grosso do Sul", "Centro-Oeste", "CO", -20.7722, -54.7852, "50"),
    ("MT", "Mato Grosso", "Centro-Oeste", "CO", -12.6819, -56.9211, "51"),
    ("PA", "Pará", "Norte", "N", -3.7913, -52.0048, "15"),
    ("PB", "Paraíba", "Nordeste", "NE", -7.2399, -36.7819, "25"),
    ("PE", "Pernambuco", "Nordeste", "NE", -8.8137, -36.9541, "26"),
    ("PI", "Piauí", "Nordeste", "NE", -7.7183, -42.7289, "22"),
    ("PR", "Paraná", "Sul", "S", -24.8900, -51.5500, "41"),
    ("RJ", "Rio de Janeiro", "Sudeste", "SE", -22.9068, -43.1729, "33"),
    ("RN", "Rio Grande do Norte", "Nordeste", "NE", -5.8127, -36.5926, "24"),
    ("RO", "Rondônia", "Norte", "N", -10.8311, -63.3700, "11"),
    ("RR", "Roraima", "Norte", "N", 1.9900, -61.3300, "14"),
    ("RS", "Rio Grande do Sul", "Sul", "S", -30.0346, -51.2177, "43"),
    ("SC", "Santa Catarina", "Sul", "S", -27.2423, -50.2189, "42"),
    ("SE", "Sergipe", "Nordeste", "NE", -10.5741, -37.3857, "28"),
    ("SP", "São Paulo", "Sudeste", "SE", -23.5505, -46.6333, "35"),
    ("TO", "Tocantins", "Norte", "N", -10.1754, -48.2982, "17"),
]
STATE_SCHEMA = "uf string, estado string, regiao string, regiao_sigla string, lat double, lon double, uf_code string"

# Fixed values. WMO weather codes and their Portuguese labels.
WMO_LABELS = {
    0: "Céu limpo",
    1: "Predominantemente limpo",
    2: "Parcialmente nublado",
    3: "Nublado",
    45: "Neblina",
    48: "Neblina com geada",
    51: "Garoa fraca",
    53: "Garoa moderada",
    55: "Garoa intensa",
    56: "Garoa fraca congelante",
    57: "Garoa intensa congelante",
    61: "Chuva fraca",
    63: "Chuva moderada",
    65: "Chuva forte",
    66: "Chuva fraca congelante",
    67: "Chuva forte congelante",
    71: "Neve fraca",
    73: "Neve moderada",
    75: "Neve forte",
    77: "Grãos de neve",
    80: "Pancadas fracas",
    81: "Pancadas moderadas",
    82: "Pancadas violentas",
    85: "Pancadas de neve fracas",
    86: "Pancadas de neve fortes",
    95: "Trovoada",
    96: "Trovoada com granizo fraco",
    99: "Trovoada com granizo forte",
}

# Fixed values. Columns that are masked, compared without case.
SENSITIVE_COLUMNS = ["cpf", "email", "phone", "document_number"]


def states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATES, STATE_SCHEMA)


def uf_of_ibge_code(code: Column | str) -> Column:
    """State of a seven-digit municipality code: its first two digits."""
    by_code = F.create_map(*[F.lit(v) for v in chain.from_iterable((s[6], s[0]) for s in STATES)])
    return F.try_element_at(by_code, F.substring(F.col(code) if isinstance(code, str) else code, 1, 2))


def wmo_label(code: Column | str) -> Column:
    """Label of a weather code; an unknown code is named by its number and NULL stays NULL."""
    c = F.col(code) if isinstance(code, str) else code
    labels = F.create_map(*[F.lit(v) for v in chain.from_iterable(WMO_LABELS.items())])
    named = F.try_element_at(labels, c.cast("int"))
    return F.when(c.isNotNull(), F.coalesce(named, F.concat(F.lit("Código "), c.cast("string"))))
