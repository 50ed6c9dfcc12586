"""Schemas of the raw tables and of the payloads they hold."""

RAW_LISTINGS = (
    "source_id string not null, run_date date not null, search_term string, "
    "payload string not null, loaded_at timestamp not null"
)
RAW_DETAILS = (
    "source_id string not null, run_date date not null, "
    "payload string not null, loaded_at timestamp not null"
)
RAW_BOARD = RAW_DETAILS
RAW_RUNS = (
    "source string not null, run_date date not null, "
    "manifest string not null, loaded_at timestamp not null"
)

# Raw table -> (schema, key columns, partition columns)
RAW_TABLES = {
    "listings": (RAW_LISTINGS, ["source_id", "run_date"], ["run_date"]),
    "details": (RAW_DETAILS, ["source_id", "run_date"], ["run_date"]),
    "board": (RAW_BOARD, ["source_id", "run_date"], ["run_date"]),
    "runs": (RAW_RUNS, ["source", "run_date"], ["source", "run_date"]),
}

# Payload fields that staging reads; everything else stays in the raw text.
LISTING_PAYLOAD = (
    "stellenangebotsTitel string, hauptberuf string, firma string, stellenangebotsart string, "
    "vertragsdauer string, arbeitszeitVollzeit string, quereinstiegGeeignet string, "
    "gehaltsspanneVon string, gehaltsspanneBis string, verguetungsangabe string, "
    "stellenlokationen array<struct<adresse: struct<ort: string, plz: string, region: string, "
    "land: string>>>, datumErsteVeroeffentlichung string, aenderungsdatum string"
)
DETAIL_PAYLOAD = (
    "stellenangebotsBeschreibung string, homeofficemoeglich string, "
    "istArbeitnehmerUeberlassung string, istPrivateArbeitsvermittlung string, vertragsdauer string"
)
BOARD_PAYLOAD = (
    "title string, company_name string, description string, location string, remote string, "
    "url string, created_at string"
)
MANIFEST = "rows_read string, duplicates_collapsed string, results_key string"
