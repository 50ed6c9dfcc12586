"""Hand-made postings, one rule per row; the outcome of each is worked out on paper."""

import json

from jobtide.plans.places import gazetteer, locate, verdict_table
from jobtide.plans.postings import scored_postings
from jobtide.plans.staging import flatten_board, flatten_details, flatten_listings, flatten_runs
from jobtide.session import local_frame
from jobtide.sources import seeds

DAY = "2026-09-12"

GERMAN = (
    "Für unser Team bauen Sie Datenstrecken in Python und SQL, pflegen ein Data Warehouse auf "
    "PostgreSQL, modellieren mit dbt und steuern Abläufe mit Airflow. Azure, Spark und Kafka sind "
    "bei uns im Einsatz. Gute Deutschkenntnisse setzen wir voraus, English hilft im Alltag."
)
ENGLISH = (
    "You own our ELT jobs in dbt and Airflow on Snowflake, write solid SQL, publish reports in "
    "Power BI and in Tableau, and help teams move workloads from AWS to Google Cloud. We speak "
    "English at work and meet remotely; the company is based in Germany and hires all over it."
)
STUB = "Mehr dazu im Gespräch."


def place(city, region, country="DEUTSCHLAND"):
    return {"adresse": {"ort": city, "plz": "00000", "region": region, "land": country}}


def listing(title, employer, *places, **more):
    body = {"stellenangebotsTitel": title, "firma": employer, **more}
    if places:
        body["stellenlokationen"] = list(places)
    return body


LISTINGS = {
    "ag1": listing(
        "Data Engineer (m/w/d)", "Acker GmbH", place("Berlin", "Berlin"), place("Hamburg", "Hamburg"),
        arbeitszeitVollzeit=True, quereinstiegGeeignet=False, gehaltsspanneVon="55000",
        gehaltsspanneBis="72000", datumErsteVeroeffentlichung="2026-09-01",
        aenderungsdatum="2026-09-05T08:30:00",
    ),
    "ag2": listing(
        "BI Spezialist", "Birke AG", place("München", "Bayern"), gehaltsspanneVon="",
        gehaltsspanneBis="", aenderungsdatum="", datumErsteVeroeffentlichung="2026-09-02",
    ),
    "ag3": listing("Bildredakteur", "Buche KG", place("Köln", "NRW")),
    "ag4": listing("Analytics Engineer", "Distel GmbH", place("Wien", "Wien", "OESTERREICH")),
    "ag5": listing("Data Warehouse Entwickler", "Esche SE"),
    "ag6": listing("Data Center Techniker", "Farn GmbH", place("Frankfurt", "Hessen")),
    "ag7": listing("Data Protection Manager", "Ginster AG", place("Bonn", "NRW")),
    "ag8": listing("Duales Studium Data Science", "Hasel SE", place("Stuttgart", "BW")),
    "ag9": listing("Sales Representative Data Products", "Iris GmbH", place("Essen", "NRW")),
    "ag10": listing("NTT DATA: AI Solution Architect", "NTT DATA", place("Muenchen", "Bayern")),
    "ag11": listing("NTT DATA: Senior Data Engineer", "NTT DATA", place("Muenchen", "Bayern")),
}

DETAILS = {
    "ag1": {"stellenangebotsBeschreibung": GERMAN, "homeofficemoeglich": True},
    "ag2": {"stellenangebotsBeschreibung": ENGLISH, "homeofficemoeglich": False, "istArbeitnehmerUeberlassung": True},
    "ag3": {"stellenangebotsBeschreibung": STUB},
    "ag4": {"stellenangebotsBeschreibung": ENGLISH},
    "ag11": {"stellenangebotsBeschreibung": ENGLISH},
}


def offer(title, employer, location, remote):
    return {
        "title": title, "company_name": employer, "location": location, "remote": remote,
        "description": ENGLISH, "created_at": "1788912000",
    }


OFFERS = {
    "an1": offer("Senior Data Engineer", "Jasmin Tech", "Berlin, Germany", True),
    "an2": offer("Data Analyst", "Klee Ltd", "London, United Kingdom", False),
    "an3": offer("Analytics Engineer", "Linde BV", "Europe - Remote", True),
    "an4": offer("Data Engineer (m/w/d)", "Acker GmbH", "Berlin", False),
    "an5": offer("Data Platform Engineer", "Malve GmbH", "Munich, Germany", False),
    "an6": offer("Analytics Engineer (m/w/d)", "Nelke AG", "Berlin; Munich; Remote", True),
    "an7": offer("BI Engineer", "Olive GmbH", "Remote / Köln", True),
    "an8": offer("Data Analyst (m/w/d)", "Pappel GmbH", "Wien", False),
}

MANIFESTS = [("arbeitsagentur", DAY, 12), ("arbeitnow", DAY, 9)]


def raw_listings(spark, items, day=DAY):
    rows = [(k, day, None, json.dumps(v)) for k, v in items]
    return local_frame(spark, rows, "source_id string, run_date string, search_term string, payload string").selectExpr(
        "source_id", "cast(run_date as date) run_date", "search_term", "payload"
    )


def raw_documents(spark, items):
    """Rows of (id, day, payload)."""
    rows = [(k, day, json.dumps(v)) for k, day, v in items]
    return local_frame(spark, rows, "source_id string, run_date string, payload string").selectExpr(
        "source_id", "cast(run_date as date) run_date", "payload"
    )


def raw_runs(spark, manifests):
    rows = [(s, d, json.dumps({"rows_read": n, "duplicates_collapsed": 1, "results_key": "x"})) for s, d, n in manifests]
    return local_frame(spark, rows, "source string, run_date string, manifest string").selectExpr(
        "source", "cast(run_date as date) run_date", "manifest"
    )


def build(spark, listings, details, offers, manifests, **options):
    """All models up to the scored rows, from (id, day, payload) triples."""
    flat = flatten_listings(raw_documents(spark, listings).selectExpr("*", "cast(null as string) search_term"))
    flat_details = flatten_details(raw_documents(spark, details))
    flat_board = flatten_board(raw_documents(spark, offers))
    places = gazetteer(flat, seeds.city_aliases(spark))
    located = locate(flat_board, places)
    scored = scored_postings(flat, flat_details, flat_board, located, **options)
    return {
        "listings": flat, "details": flat_details, "board": flat_board, "places": places,
        "located": located, "verdicts": verdict_table(located), "scored": scored, "runs": flatten_runs(raw_runs(spark, manifests)),
    }


def one_day(spark, **options):
    return build(
        spark,
        [(k, DAY, v) for k, v in LISTINGS.items()],
        [(k, DAY, v) for k, v in DETAILS.items()],
        [(k, DAY, v) for k, v in OFFERS.items()],
        MANIFESTS,
        **options,
    )
