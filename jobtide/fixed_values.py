"""Word lists, patterns and tables that decide the published results.

Each value below is a reviewed rule of the data product and has to stay as it is for results to
agree with earlier runs. They are kept together and written out in full, in natural order.
"""

# --- Fixed values: dictionary of tools (skill_key, display_name, category, pattern) ---
SKILLS = [
    ("azure", "Azure", "cloud", "azure"),
    ("aws", "AWS", "cloud", "aws|amazon web services"),
    ("gcp", "Google Cloud", "cloud", "gcp|google cloud"),
    ("databricks", "Databricks", "platform", "databricks"),
    ("fabric", "Microsoft Fabric", "platform", "microsoft fabric"),
    ("snowflake", "Snowflake", "warehouse", "snowflake"),
    ("bigquery", "BigQuery", "warehouse", "bigquery"),
    ("redshift", "Redshift", "warehouse", "redshift"),
    ("synapse", "Azure Synapse", "warehouse", "synapse"),
    ("dbt", "dbt", "transformation", "dbt"),
    ("airflow", "Airflow", "orchestration", "airflow"),
    ("dagster", "Dagster", "orchestration", "dagster"),
    ("datafactory", "Azure Data Factory", "orchestration", "data factory|adf"),
    ("spark", "Spark", "processing", "spark|pyspark"),
    ("kafka", "Kafka", "streaming", "kafka"),
    ("flink", "Flink", "streaming", "flink"),
    ("python", "Python", "language", "python"),
    ("sql", "SQL", "language", "sql"),
    ("scala", "Scala", "language", "scala"),
    ("java", "Java", "language", "java"),
    ("oracle", "Oracle", "database", "oracle"),
    ("postgres", "PostgreSQL", "database", "postgres|postgresql"),
    ("sqlserver", "SQL Server", "database", "sql server|mssql|t-sql"),
    ("mongodb", "MongoDB", "database", "mongodb"),
    ("sap", "SAP", "platform", "sap"),
    ("powerbi", "Power BI", "bi", "power bi|powerbi"),
    ("tableau", "Tableau", "bi", "tableau"),
    ("looker", "Looker", "bi", "looker"),
    ("docker", "Docker", "platform", "docker"),
    ("kubernetes", "Kubernetes", "platform", "kubernetes|k8s"),
    ("terraform", "Terraform", "platform", "terraform"),
    ("etl", "ETL / ELT", "concept", "etl|elt"),
    ("warehouse", "Data Warehouse", "concept", "data warehouse|datawarehouse|dwh"),
    ("lakehouse", "Data Lake / Lakehouse", "concept", "data lake|delta lake|lakehouse"),
]

# --- Fixed values: foreign spellings of German cities (alias, city, note) ---
CITY_ALIASES = [
    ("munich", "München", "English exonym"),
    ("cologne", "Köln", "English exonym"),
    ("nuremberg", "Nürnberg", "English exonym"),
    ("hanover", "Hannover", "English exonym"),
    ("brunswick", "Braunschweig", "English exonym"),
    ("treves", "Trier", "English exonym"),
    ("ratisbon", "Regensburg", "English exonym"),
    ("aix-la-chapelle", "Aachen", "French exonym"),
]

# --- Fixed values: words that place a location outside Germany ---
FOREIGN_TERMS = [
    "france", "french", "united kingdom", "great britain", "england", "scotland", "wales",
    "ireland", "netherlands", "holland", "belgium", "spain", "portugal", "italy", "poland",
    "czech", "austria", "switzerland", "sweden", "norway", "denmark", "finland", "greece",
    "romania", "hungary", "turkey", "usa", "united states", "canada", "india", "london", "paris",
    "madrid", "lisbon", "amsterdam", "brussels", "dublin", "vienna", "zurich", "milan", "warsaw",
    "prague",
]

# --- Fixed values: title scope. "bi" counts only where the word ends after it. ---
SCOPE_TERMS = ["data", "analytics", "bi" + r"(?![\p{L}\p{N}_])", "business intelligence", "etl"]
SCOPE_EXCLUSIONS = [
    "data ?cent(er|re)",
    "rechenzentr",
    "data protection",
    "datenschutz",
    "vertrieb",
    "sales (specialist|representative|professional|consultant|manager|engineer|support)",
    "account manager",
    "dual(es|er|e|en)?[ -](studium|student|bachelor|master|hochschul|studien)",
    "dhbw",
]
SCOPE_EMPLOYER_NOISE = "ntt data"
SCOPE_ROLE_PREFIXES = ["data", "analytics", "bi"]
SCOPE_ROLE_GAP = "[ /&-]*"
SCOPE_ROLE_WORDS = [
    "engineer", "engineering", "scientist", "science", "analyst", "analytics", "architect",
    "warehouse", "platform", "steward", "governance", "migration", "integration",
]

# --- Fixed values: language phrases looked for in the description ---
GERMAN_REQUIRED = [
    "deutschkenntnis", "fließend(e|es)? deutsch", "verhandlungssicher", "sehr gute deutsch",
    "gute deutschkenntnisse",
]
ENGLISH_MENTIONED = ["english", "englischkenntnis", "englisch"]

# --- Fixed values: German data words used when auditing dropped titles ---
RESCUE_TERMS = ["daten", "datenbank", "auswertung", "informationsmanagement"]

# --- Fixed values: tools whose short patterns are read in context; tools named in the headline ---
RISKY_SKILLS = ["etl", "sap", "java", "sql", "dbt", "aws", "gcp", "spark"]
CLOUD_SKILLS = ["azure", "aws", "gcp"]

# --- Fixed values: field names the federal API has used, newest first ---
ID_FIELDS = ["referenznummer", "refnr", "hashId"]
RESULT_KEYS = ["ergebnisliste", "stellenangebote"]
TOTAL_KEYS = ["maxErgebnisse", "maxErgebnisseGesamt", "gesamtAnzahl"]

# --- Fixed values: source tags, country verdicts ---
FEDERAL = "arbeitsagentur"
BOARD = "arbeitnow"
HOME_COUNTRY = "DEUTSCHLAND"
FOREIGN = "FOREIGN"

# --- Fixed values: the eight funnel stages (order, stage, grain) ---
FUNNEL_STAGES = [
    (1, "rows_read", "posting-run"),
    (2, "distinct_postings", "posting-run"),
    (3, "title_in_scope", "posting-run"),
    (4, "in_germany", "posting-run"),
    (5, "latest_snapshot", "posting"),
    (6, "still_advertised", "posting"),
    (7, "deduplicated", "posting"),
    (8, "with_description", "posting"),
]

# --- Fixed values: names of the published tables; the funnel may be absent on early days ---
MART_NAMES = [
    "mart_skill_frequency",
    "mart_language_requirement",
    "mart_city_stats",
    "mart_salary_by_skill",
    "mart_pipeline_funnel",
]
OPTIONAL_MARTS = ["mart_pipeline_funnel"]
