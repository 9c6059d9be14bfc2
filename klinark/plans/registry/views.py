"""DuckDB views of the stand-in sources, inlined in front of the oracle queries."""

from __future__ import annotations

from klinark.plans.standins import CAMPAIGNS, FIRST_YEAR, LAST_YEAR, MASTER, SEED

DATE_SHAPE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def band_case(age: str) -> str:
    return (f"CASE WHEN {age} IS NULL OR {age} < 0 OR {age} > 120 THEN 'Inconnu' WHEN {age} < 20 THEN '0-19' "
            f"WHEN {age} < 40 THEN '20-39' WHEN {age} < 60 THEN '40-59' WHEN {age} < 75 THEN '60-74' "
            f"WHEN {age} < 85 THEN '75-84' ELSE '85+' END")


def pseudonym_sql(identifier: str) -> str:
    return f"sha256({identifier} || '{MASTER}' || sha256({identifier} || '{SEED}'))"


VIEWS = {
    "v_ref": """SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code_departement,
        CASE WHEN n_nationkey >= 20 THEN '00' ELSE lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0') END AS code_region,
        CASE WHEN n_nationkey >= 20 THEN n_name ELSE r_name END AS nom_region
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "v_geo": """SELECT code_region AS geo_id, code_region,
        CASE WHEN count(DISTINCT nom_region) > 1 THEN 'Collectivités d''outre-mer' ELSE min(nom_region) END AS region
        FROM v_ref GROUP BY code_region UNION ALL SELECT 'INCONNU', NULL, 'INCONNU'""",
    "v_line": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, l_quantity, l_shipdate, o_orderdate,
        CASE WHEN l_partkey % 50 = 0 THEN '' ELSE p_type END AS code, CAST(o_orderdate AS DATE) AS jour,
        year(o_orderdate) AS annee, l_shipdate >= o_orderdate AS duree_valide,
        date_diff('second', o_orderdate, l_shipdate) / 60.0 AS minutes
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey""",
    "v_stay": """SELECT CAST(l_orderkey AS VARCHAR) AS num_stay, l_linenumber AS line_no, l_partkey AS part_no,
        CASE WHEN o_custkey % 61 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS id_patient,
        CASE WHEN l_suppkey % 40 = 0 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS id_site,
        code AS code_diag,
        CASE WHEN l_orderkey % 97 = 0 THEN '32/13/1999'
             ELSE lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0') || '/' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0')
                  || '/' || CAST(year(l_shipdate) AS VARCHAR) END AS date_entree,
        CAST(CASE WHEN l_partkey % 89 = 0 THEN -l_quantity ELSE l_quantity END AS INTEGER) AS jours
        FROM v_line""",
    "v_stay_reason": f"""SELECT *, CAST(try_strptime(date_entree, '%d/%m/%Y') AS DATE) AS entree,
        CASE WHEN id_patient IS NULL THEN 'PATIENT_NULL' WHEN id_site IS NULL THEN 'ETAB_NULL'
             WHEN try_strptime(date_entree, '%d/%m/%Y') IS NULL THEN 'DATE_INVALIDE'
             WHEN jours < 0 THEN 'DUREE_NEGATIVE'
             WHEN year(try_strptime(date_entree, '%d/%m/%Y')) NOT BETWEEN {FIRST_YEAR} AND {LAST_YEAR} THEN 'HORS_PLAGE'
        END AS raison_rejet FROM v_stay""",
    "v_stay_ok": f"""SELECT *, year(entree) AS annee, CAST(strftime(entree, '%Y%m%d') AS INTEGER) AS date_id,
        {pseudonym_sql('id_patient')} AS patient_id,
        CASE WHEN trim(code_diag) = '' THEN 'UNKNOWN' ELSE code_diag END AS diag_id
        FROM (SELECT *, row_number() OVER (PARTITION BY id_patient, num_stay, date_entree
                                           ORDER BY line_no, part_no, id_site) AS rn
              FROM v_stay_reason WHERE raison_rejet IS NULL) WHERE rn = 1""",
    "v_visit_ok": f"""SELECT *, CASE WHEN trim(code) = '' THEN 'UNKNOWN' ELSE code END AS diag_id,
        CAST(l_suppkey AS VARCHAR) AS prof_id, CAST(strftime(jour, '%Y%m%d') AS INTEGER) AS date_id,
        {pseudonym_sql('CAST(o_custkey AS VARCHAR)')} AS patient_id
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                           ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn
              FROM v_line WHERE annee BETWEEN {FIRST_YEAR} AND {LAST_YEAR}) WHERE rn = 1""",
    "v_death": """SELECT CAST(o_orderkey AS VARCHAR) AS acte,
        CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '9' END AS sexe,
        CASE WHEN o_custkey % 53 = 0 THEN NULL
             ELSE CAST(year(o_orderdate) - o_custkey % 130 AS VARCHAR) || '-01-01' END AS date_naissance,
        CASE WHEN o_orderkey % 101 = 0 THEN 'X' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_deces,
        CASE WHEN o_orderkey % 71 = 0 THEN '99001' ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '001' END AS lieu
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "v_death_ok": f"""SELECT d.*, CAST(replace(date_deces, '-', '') AS INTEGER) AS date_id,
        coalesce(code_region, 'INCONNU') AS geo_id,
        CASE sexe WHEN '1' THEN 'M' WHEN '2' THEN 'F' ELSE '?' END AS sx,
        {band_case('age')} AS tranche_age, CAST(substr(date_deces, 1, 4) AS INTEGER) AS annee
        FROM (SELECT *, CAST(substr(date_deces, 1, 4) AS INTEGER)
                        - TRY_CAST(substr(date_naissance, 1, 4) AS INTEGER) AS age
              FROM v_death WHERE regexp_matches(date_deces, '{DATE_SHAPE}')
                             AND TRY_CAST(date_deces AS DATE) IS NOT NULL
                             AND CAST(substr(date_deces, 1, 4) AS INTEGER) >= {FIRST_YEAR}) d
        LEFT JOIN v_ref ON code_departement = CASE WHEN substr(lieu, 1, 2) IN ('97', '98')
                                                   THEN substr(lieu, 1, 3) ELSE substr(lieu, 1, 2) END""",
    "v_survey": """SELECT CAST(s_suppkey AS VARCHAR) AS site, s_name AS nom, r_name AS region_std,
        CASE WHEN s_suppkey % 3 = 0 THEN replace(lower(r_name), ' ', '-') ELSE r_name END AS region,
        CASE WHEN s_suppkey % 7 = 0 THEN '' WHEN s_suppkey % 31 = 0 THEN 'n/a'
             ELSE CAST(CAST(floor(s_acctbal / 100) AS INTEGER) AS VARCHAR) || ',5' END AS texte
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "v_survey_reason": """SELECT *, TRY_CAST(replace(texte, ',', '.') AS DECIMAL(18, 4)) AS score,
        CASE WHEN trim(texte) = '' THEN 'NOTE_NULLE'
             WHEN TRY_CAST(replace(texte, ',', '.') AS DECIMAL(18, 4)) IS NULL THEN 'NOTE_NON_NUMERIQUE'
             WHEN TRY_CAST(replace(texte, ',', '.') AS DECIMAL(18, 4)) NOT BETWEEN 0 AND 100 THEN 'NOTE_HORS_PLAGE'
             WHEN site NOT IN (SELECT etab_id FROM v_site) THEN 'ETAB_INCONNU' END AS raison_rejet
        FROM v_survey""",
    "v_site": """SELECT CAST(s_suppkey AS VARCHAR) AS etab_id, s_suppkey, r_name AS region, n_name AS pays
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "v_survey_ok": """SELECT s.*, coalesce(g.geo_id, 'INCONNU') AS geo_id,
        CAST(floor(score + 0.5) / 10 AS DECIMAL(3, 1)) AS note
        FROM v_survey_reason s LEFT JOIN v_geo g
          ON regexp_replace(lower(g.region), '[ .''-]', '', 'g') = regexp_replace(lower(s.region), '[ .''-]', '', 'g')
        WHERE raison_rejet IS NULL""",
    "v_campaign": f"""SELECT annee, site, k, q, TRY_CAST(replace(texte, ',', '.') AS DOUBLE) AS score FROM (
        SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, l_suppkey AS k, CAST(l_suppkey AS VARCHAR) AS site,
               CAST(sum(l_quantity) AS BIGINT) AS q,
               CASE WHEN l_suppkey % 9 = 0 THEN '' WHEN l_suppkey % 37 = 0 THEN 'n/a'
                    ELSE CAST(CAST(sum(l_quantity) AS BIGINT) % 104 AS VARCHAR) || ',5' END AS texte
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE year(o_orderdate) IN {CAMPAIGNS} GROUP BY 1, 2)""",
    "v_site_geo": """SELECT site, nom, coalesce(g.geo_id, 'INCONNU') AS geo_id, coalesce(g.region, 'INCONNU') AS region
        FROM v_survey s LEFT JOIN v_geo g
          ON regexp_replace(lower(g.region), '[ .''-]', '', 'g') = regexp_replace(lower(s.region), '[ .''-]', '', 'g')""",
    "v_patient": f"""SELECT CAST(c_custkey AS VARCHAR) AS id_patient, r_name AS region_residence,
        CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'M'
             WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'F' ELSE '?' END AS sexe,
        {band_case('(CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_custkey % 127 END)')} AS tranche_age
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
}

NEEDS = {
    "v_geo": ("v_ref",), "v_stay": ("v_line",), "v_stay_reason": ("v_stay",), "v_stay_ok": ("v_stay_reason",),
    "v_visit_ok": ("v_line",), "v_death_ok": ("v_death", "v_ref"), "v_survey_reason": ("v_survey", "v_site"),
    "v_survey_ok": ("v_survey_reason", "v_geo"), "v_site_geo": ("v_survey", "v_geo"),
}


def oracle(views: str, body: str) -> str:
    """A query preceded by the views it names (space-separated) and those they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        add(name)
    head = ", ".join(f"{name} AS ({VIEWS[name]})" for name in ordered)
    return f"WITH {head} {body}" if head else body
