"""Vacancies from stored API responses and web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rosterlake.functions import parse_timestamp
from rosterlake.operators.joins import frontier
from rosterlake.operators.mapping import Rule, classify
from rosterlake.operators.writes import insert_if_absent
from rosterlake.sources.web import CardMarkup, VACANCY_PAGE, html_cards, json_items

# Rules on lower-cased titles in the order they apply; the last match wins.
API_RULES = (
    Rule(1, ("водитель-курьер",)),
    Rule(1, ("курьер-водитель",)),
    Rule(1, ("водитель - курьер",)),
    Rule(1, ("водитель курьер",)),
    Rule(1, ("водитель на доставку",)),
    Rule(1, ("авто-курьер",)),
    Rule(1, ("автокурьер",)),
    Rule(4, ("велокурьер",)),
    Rule(4, ("вело-курьер",)),
    Rule(4, ("на велосипеде",)),
    Rule(7, ("мотокурьер",)),
    Rule(2, ("пеший",)),
    Rule(3, ("сборщик заказов",)),
    Rule(3, ("сборщик-курьер",)),
    Rule(3, ("комплектовщик заказов",)),
    Rule(3, ("сборщик (комплектовщик) заказов",)),
    Rule(9, ("водитель", "экспедитор")),
    Rule(10, ("курьер", "личн")),
    Rule(10, ("курьер", "собственн")),
    Rule(10, ("курьер", "своем")),
    Rule(10, ("курьер", "с автомобил")),
    Rule(11, ("курьер", "на авто", "компани")),
    Rule(11, ("курьер на служебном автомобиле",)),
    Rule(0, ("курьер", "сборщик")),
    Rule(0, ("пеший", "сборщик")),
    Rule(0, ("водитель на автомобиль компании / личном автомобиле",)),
    Rule(0, ("грузовом",), only_if=1),
)
WEB_RULES = (
    Rule(1, ("курьер на авто",)),
    Rule(1, ("водитель курьер",)),
    Rule(1, ("курьер водитель",)),
    Rule(1, ("водитель-курьер",)),
    Rule(1, ("курьер-водитель",)),
    Rule(1, ("автокурьер",)),
    Rule(1, ("водитель - курьер",)),
    Rule(1, ("водителем курьером",)),
    Rule(1, equals="курьер-почтальон (на авто)"),
    Rule(1, ("водители курьеры",)),
    Rule(1, ("курьер", "на авто")),
    Rule(2, ("пеший курьер",)),
    Rule(2, ("курьер пеший",)),
    Rule(3, equals="сборщик заказов"),
    Rule(3, ("сбор", "заказов")),
    Rule(3, ("сбор", "товаров")),
    Rule(3, ("комплектовщик",)),
    Rule(3, ("комплектовка заказов",)),
    Rule(3, ("сборщик продуктов",)),
    Rule(3, ("водитель на доставку",)),
    Rule(4, ("велокурьер",)),
    Rule(4, equals="курьер (вело)"),
    Rule(4, equals="курьер на велосипеде"),
    Rule(9, ("водител", "экспедитор")),
    Rule(10, ("курьер с авто",)),
    Rule(10, ("курьер", "со своим авто")),
    Rule(10, ("курьер", "с личным авто")),
    Rule(10, ("курьер", "на личном авто")),
    Rule(10, ("курьер", "на своем авто")),
    Rule(11, ("курьер на авто компани",)),
)

# Searches sent to the API and to the web site, and the markup of its cards.
API_SPECIALISATIONS = ("4.127", "21.482", "21.506")
API_FORWARDER = "21.482"
WEB_SEARCHES = (
    {"tag": "/tag/kurer-na-avtomobile", "query": ""},
    {"tag": "/tag/peshij-kurer", "query": ""},
    {"tag": "", "query": "сборщик+заказов"},
    {"tag": "", "query": "водитель+экспедитор"},
)
WEB_CARDS = CardMarkup("iva-item-body", "iva-item-description-", "item-link")
WEB_PAGER, WEB_COUNTER = "pagination-item", "page-title-count"

# Ids of the web site's regions.
WEB_REGIONS = {
    "moskva": 1, "moskovskaya_oblast": 2, "ekaterinburg": 3, "samara": 4, "sankt-peterburg": 5,
    "nizhniy_novgorod": 6, "krasnodar": 7, "novosibirsk": 8, "ryazan": 9, "sochi": 10,
    "krasnoyarsk": 11, "ufa": 12, "perm": 13, "saratov": 14, "voronezh": 15, "orenburg": 16,
    "volgograd": 17, "chelyabinsk": 18, "rostov-na-donu": 19, "omsk": 20, "tver": 21,
    "belgorod": 22, "ivanovo": 23, "tyumen": 24, "ulyanovsk": 25, "vladimir": 26, "orel": 28,
    "tolyatti": 29, "tula": 30, "kursk": 31, "yaroslavl": 32, "kaliningrad": 33, "smolensk": 34,
    "kazan": 64, "kemerovo": 65, "magnitogorsk": 66, "kaluga": 67, "stavropol": 69, "penza": 70,
    "tambov": 71, "cheboksary": 72, "novorossiysk": 73, "naberezhnye_chelny": 74,
    "nizhnevartovsk": 75, "arhangelsk": 77, "kirovskaya_oblast_kirov": 78, "tomsk": 80,
    "astrahan": 81, "velikiy_novgorod": 82, "murmansk": 83, "cherepovets": 84, "izhevsk": 85,
    "kostroma": 86, "petrozavodsk": 88, "surgut": 89, "bryansk": 90, "vologda": 91, "lipetsk": 92,
    "novokuznetsk": 93, "barnaul": 96, "syktyvkar": 98, "balakovo": 99, "irkutsk": 102,
    "anapa": 103, "armavir": 104, "vladivostok": 105, "vyborg": 106, "kingisepp": 108,
    "severodvinsk": 111, "taganrog": 112, "shahty": 113, "habarovsk": 114, "sterlitamak": 115,
    "nalchik": 122, "leningradskaya_oblast": 124, "ulan-ude": 127, "chita": 128,
    "yuzhno-sahalinsk": 129, "nizhnekamsk": 131, "elabuga": 135, "pskov": 138, "engels": 139,
    "volgogradskaya_oblast_volzhskiy": 143, "nizhniy_tagil": 154,
}

API_COLUMNS = (
    "vacancy_id", "vacancy_name", "region", "speciality_id", "employer_id", "employer_name",
    "salary_min", "salary_max", "gross", "published_at", "type_vacancy", "requirements",
)
WEB_COLUMNS = (
    "vacancy_id", "vacancy_name", "region", "speciality_id", "employer_name", "salary", "description",
)
PUBLISHED = ("yyyy-MM-dd'T'HH:mm:ssxx", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss")


def api_frontier(areas: DataFrame) -> DataFrame:
    """Requests to send: every area with every specialisation, forwarders searched by name."""
    searches = [
        {
            "specialization": s,
            "search_field": "name" if s == API_FORWARDER else "",
            "text": "экспедитор" if s == API_FORWARDER else "",
        }
        for s in API_SPECIALISATIONS
    ]
    return frontier(areas, searches)


def web_frontier(regions: DataFrame, base: str) -> DataFrame:
    """Addresses to fetch: every region (``region_name, region_id``) with every search."""
    pairs = frontier(regions, WEB_SEARCHES)
    return pairs.select(
        "region_id", F.concat(F.lit(base), "region_name", F.lit("/vakansii"), "tag").alias("link"), "query"
    )


def api_vacancies(pages: DataFrame, json: str = "body") -> DataFrame:
    """Distinct, typed and classified vacancies of stored API pages."""
    item = json_items(pages, json, VACANCY_PAGE, "items")
    flat = item.select(
        F.col("item.id").alias("vacancy_id"),
        F.lower("item.name").alias("vacancy_name"),
        F.col("item.area.id").cast("bigint").alias("region"),
        F.col("item.employer.id").alias("employer_id"),
        F.coalesce("item.employer.name", F.lit("")).alias("employer_name"),
        F.col("item.salary.from").alias("salary_min"),
        F.col("item.salary.to").alias("salary_max"),
        F.coalesce("item.salary.gross", F.lit(False)).alias("gross"),
        parse_timestamp(F.col("item.published_at"), PUBLISHED).alias("published_at"),
        F.col("item.type.id").alias("type_vacancy"),
        F.coalesce("item.snippet.requirement", F.lit("")).alias("requirements"),
    ).dropDuplicates()
    return classify(flat, "vacancy_name", "speciality_id", API_RULES).select(*API_COLUMNS)


def web_vacancies(pages: DataFrame, html: str = "html", region: str = "region") -> DataFrame:
    """Distinct and classified vacancies of stored result pages."""
    cards = html_cards(pages, html, [region], WEB_CARDS)
    flat = cards.select(
        F.col("href").alias("vacancy_id"),
        F.lower("title").alias("vacancy_name"),
        F.col(region).alias("region"),
        F.coalesce("employer", F.lit("")).alias("employer_name"),
        F.col("price").alias("salary"),
        F.coalesce("description", F.lit("")).alias("description"),
    ).dropDuplicates()
    return classify(flat, "vacancy_name", "speciality_id", WEB_RULES).select(*WEB_COLUMNS)


def new_vacancies(
    table: DataFrame, found: DataFrame, columns: tuple[str, ...], null_safe: bool = False
) -> DataFrame:
    """Vacancies to append. As in SQL a row holding a null counts as new on every run unless
    ``null_safe``."""
    return insert_if_absent(table, found, columns, null_safe)
