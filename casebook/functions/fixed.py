"""Fixed values that source data and stored records agree on: names, word lists, lookup tables, patterns."""

from __future__ import annotations

# --- Fixed values: ordered court-name replacements (each applies to the result of those before it). ---
INSTANCES = (
    ("Sector kanton Rechtbank", "Rechtbank"),
    ("Kantongerecht", "Rechtbank"),
    ("'s Gravenhage", "'s-Gravenhage"),
    ("Den Haag", "'s-Gravenhage"),
    ("Alkmaar", "Noord-Holland"),
    ("Almelo", "Overijssel"),
    ("Alphen aan den Rijn", "'s-Gravenhage"),
    ("Amersfoort", "Midden-Nederland"),
    ("Apeldoorn", "Gelderland"),
    ("Appingedam", "Noord-Nederland"),
    ("Assen", "Noord-Holland"),
    ("Beetsterzwaag", "Noord-Nederland"),
    ("Bergen op Zoom", "Zeeland-West-Brabant"),
    ("Bergum", "Noord-Nederland"),
    ("Bolsward", "Noord-Nederland"),
    ("Boxmeer", "Oost-Brabant"),
    ("Breda", "Zeeland-West-Brabant"),
    ("Breukelen-Nijenrode", "Midden-Nederland"),
    ("Brielle", "Rotterdam"),
    ("Delft", "'s-Gravenhage"),
    ("Den Helder", "Noord-Holland"),
    ("Deventer", "Overijssel"),
    ("Dordrecht", "Rotterdam"),
    ("Eindhoven", "Oost-Brabant"),
    ("Elst", "Gelderland"),
    ("Emmen", "Noord-Nederland"),
    ("Enschede", "Overijssel"),
    ("Geldermalsen", "Gelderland"),
    ("Goes", "Zeeland-West-Brabant"),
    ("Goor", "Overijssel"),
    ("Gorinchem", "Rotterdam"),
    ("Gouda", "'s-Gravenhage"),
    ("Groenlo", "Gelderland"),
    ("Groningen", "Noord-Nederland"),
    ("Gulpen", "Limburg"),
    ("Haarlem", "Noord-Holland"),
    ("Haarlemmermeer", "Noord-Holland"),
    ("Harderwijk", "Gelderland"),
    ("Heerenveen", "Noord-Nederland"),
    ("Heerlen", "Limburg"),
    ("Helmond", "Oost-Brabant"),
    ("Hilversum", "Midden-Nederland"),
    ("Hoofddorp", "Noord-Holland"),
    ("Hoogeveen", "Noord-Nederland"),
    ("Hoorn", "Noord-Holland"),
    ("Kampen", "Noord-Nederland"),
    ("Leiden", "'s-Gravenhage"),
    ("Lelystad", "Midden-Nederland"),
    ("Lemmer", "Noord-Nederland"),
    ("Maastricht", "Limburg"),
    ("Medemblik", "Noord-Holland"),
    ("Meppel", "Noord-Nederland"),
    ("Middelburg", "Zeeland-West-Brabant"),
    ("Nijmegen", "Gelderland"),
    ("Ommen", "Overijssel"),
    ("Onderdendam", "Noord-Nederland"),
    ("Oost-Nederland", "Gelderland"),
    ("Oostburg", "Zeeland-West-Brabant"),
    ("Oud-Beijerland", "Rotterdam"),
    ("Purmerend", "Noord-Holland"),
    ("Ridderkerk", "Rotterdam"),
    ("Roermond", "Limburg"),
    ("Schiedam", "Rotterdam"),
    ("Schoonhoven", "Rotterdam"),
    ("Sittard", "Limburg"),
    ("Sliedrecht", "Rotterdam"),
    ("Sneek", "Noord-Nederland"),
    ("Sommelsdijk", "Rotterdam"),
    ("Steenwijk", "Overijssel"),
    ("Terborg", "Gelderland"),
    ("Terneuzen", "Zeeland-West-Brabant"),
    ("Tholen", "Zeeland-West-Brabant"),
    ("Tiel", "Gelderland"),
    ("Tilburg", "Zeeland-West-Brabant"),
    ("Utrecht", "Midden-Nederland"),
    ("Veendam", "Noord-Nederland"),
    ("Venlo", "Limburg"),
    ("Wageningen", "Gelderland"),
    ("Weert", "Limburg"),
    ("Winschoten", "Noord-Nederland"),
    ("Woerden", "Midden-Nederland"),
    ("Zaandam", "Noord-Holland"),
    ("Zevenbergen", "Zeeland-West-Brabant"),
    ("Zierikzee", "Zeeland-West-Brabant"),
    ("Zuidbroek", "Noord-Nederland"),
    ("Zutphen", "Gelderland"),
    ("Zwolle", "Overijssel"),
    ("Zwolle-Lelystad", "Overijssel"),
    ("Rechtbank 's-Hertogenbosch", "Rechtbank Oost-Brabant"),
    ("Rechtbank Arnhem", "Rechtbank Gelderland"),
    ("Gerechtshof Arnhem", "Gerechtshof Arnhem-Leeuwarden"),
    ("Rechtbank Leeuwarden", "Rechtbank Noord-Nederland"),
    ("Gerechtshof Leeuwarden", "Gerechtshof Arnhem-Leeuwarden"),
    ("Arnhem-Leeuwarden-Leeuwarden", "Arnhem-Leeuwarden"),
)

# --- Fixed values: jurisdictions. ---
JURISDICTIONS = {"NL": "NL", "Nederland": "NL"}

# --- Fixed values: the label of a domain without subdomain. ---
UNLABELLED = "Algemeen/Overig/Niet-gelabeld"

# --- Fixed values: groups of courts by which a network can be filtered. ---
COURT_GROUPS = {
    "GERECHTSHOVEN": ("Gerechtshof Amsterdam", "Gerechtshof Arnhem-Leeuwarden", "Gerechtshof 's-Gravenhage", "Gerechtshof 's-Hertogenbosch"),
    "RECHTBANKEN": (
        "Rechtbank Amsterdam", "Rechtbank 's-Gravenhage", "Rechtbank Gelderland", "Rechtbank Limburg", "Rechtbank Midden-Nederland", "Rechtbank Noord-Holland",
        "Rechtbank Noord-Nederland", "Rechtbank Oost-Brabant", "Rechtbank Overijssel", "Rechtbank Rotterdam", "Rechtbank Zeeland-West-Brabant",
    ),
    "ANDERE": (
        "Constitutioneel Hof Sint Maarten",
        "Gemeenschappelijk Hof van Justitie van Aruba, Curaçao, Sint Maarten en van Bonaire, Sint Eustatius en Saba",
        "Gerecht in Ambtenarenzaken van Aruba, Curaçao, Sint Maarten en van Bonaire, Sint Eustatius en Saba",
        "Gerecht in Eerste Aanleg van Aruba",
        "Gerecht in eerste aanleg van Bonaire, Sint Eustatius en Saba",
        "Gerecht in eerste aanleg van Curaçao",
        "Gerecht in eerste aanleg van Sint Maarten",
        "Raad van Beroep in Ambtenarenzaken van Aruba, Curaçao, Sint Maarten en van Bonaire, Sint Eustatius en Saba",
        "Raad van Beroep voor Belastingzaken van Aruba, Curaçao, Sint Maarten en van Bonaire, Sint Eustatius en Saba",
    ),
}

# --- Fixed values: source columns of Dutch decisions and the names of the canonical record. ---
DUTCH_FIELDS = (
    ("ecli", "ECLI"), ("issued", "date_publication"), ("language", "language"), ("creator", "instance"), ("date_decision", "date_decision"),
    ("zaaknummer", "case_number"), ("type", "document_type"), ("procedure", "procedure_type"), ("spatial", "jurisdiction_city"), ("subject", "domains"),
    ("relation", "predecessor_successor_cases"), ("references", "referenced_legislation_titles"), ("hasVersion", "alternative_publications"),
    ("link", "url_publication"), ("title", "title"), ("inhoudsindicatie", "summary"), ("info", "info"), ("full_text", "full_text"),
    ("jurisdiction_country", "jurisdiction_country"), ("source", "source"), ("citations_incoming", "cited_by"), ("citations_outgoing", "citing"),
    ("legislations_cited", "legislations_cited"), ("summary", "summary"), ("bwb_id", "bwb_id"),
)
#: One more column where opinions are joined to their decisions.
DUTCH_OPINION_FIELDS = (*DUTCH_FIELDS, ("ecli_decision", "ecli_decision"))

# --- Fixed values: source columns of the EU court. ---
EU_FIELDS = (
    ("CASE LAW COMMENTED BY AGENT", "commented_by_agent"), ("celex_directory_codes", "directory_codes"), ("celex_eurovoc", "eurovoc"),
    ("celex_keywords", "keywords"), ("celex_summary", "summary"), ("WORK CITES WORK. CI / CJ", "citations"), ("citing", "citing"), ("cited_by", "cited_by"),
    ("CASE LAW DELIVERED BY COURT FORMATION", "delivered_by_court_formation"), ("CASE LAW HAS A JUDICIAL PROCEDURE TYPE", "judicial_type_procedure"),
    ("CASE LAW HAS A TYPE OF PROCEDURE", "type_procedure"), ("CASE LAW HAS CONCLUSIONS", "conclusions"), ("CASE LAW INTERPRETS LEGAL RESOURCE", "legal_resource"),
    ("CASE LAW ORIGINATES IN COUNTRY", "origin_country"), ("CASE LAW ORIGINATES IN COUNTRY OR USES A ROLE QUALIFIER", "origin_country_or_role_qualifier"),
    ("CELEX IDENTIFIER", "celex"), ("DATE OF DOCUMENT", "date_publication"), ("DATE OF REQUEST FOR AN OPINION", "date_of_request"), ("ECLI", "ECLI"),
    ("LEGACY DATE OF CREATION OF WORK", "date_of_creation"), ("LEGAL RESOURCE BASED ON TREATY CONCEPT", "based_on_treaty"),
    ("LEGAL RESOURCE IS ABOUT SUBJECT MATTER", "subject_matter"), ("NATIONAL JUDGEMENT", "national_judgement"), ("RELATED JOURNAL ARTICLE", "references_journals"),
    ("SECTOR IDENTIFIER", "sector"), ("WORK HAS RESOURCE TYPE", "resource_type"), ("YEAR OF THE LEGAL RESOURCE", "judgement_year"),
    ("CASE LAW USES LANGUAGE OF PROCEDURE", "language_procedure"), ("advocate_general", "advocate_general"), ("judge_rapporteur", "judge_rapporteur"),
    ("affecting_ids", "affecting_ids"), ("affecting_strings", "affecting_string"), ("citations_extra_info", "citations_extra_info"),
)

# --- Fixed values: source columns of the human-rights court. ---
RIGHTS_FIELDS = (
    ("itemid", "document_id"), ("applicability", "referenced_legislation_titles"), ("appno", "applicants"), ("article", "domains"), ("conclusion", "summary"),
    ("docname", "title"), ("doctype", "source"), ("doctypebranch", "document_type"), ("ecli", "ECLI"), ("importance", "importance"),
    ("judgementdate", "date_decision"), ("languageisocode", "language"), ("originatingbody", "instance"), ("representedby", "representation"),
    ("respondent", "respondent"), ("separateopinion", "separate_opinion"), ("sharepointid", "sharepointid"), ("violation", "violation"),
    ("nonviolation", "nonviolation"), ("publishedby", "alternative_publications"), ("externalsources", "sources"), ("extractedappno", "extractedappno"),
    ("scl", "citations"), ("DocId", "docid"), ("WorkId", "workid"), ("Author", "author"), ("Path", "path"), ("Description", "description"),
)

# --- Fixed values: EU columns that pruning keeps, and resource types that stay. ---
EU_KEPT = (
    "CASE LAW COMMENTED BY AGENT", "CASE LAW DELIVERED BY COURT FORMATION", "CASE LAW HAS A JUDICIAL PROCEDURE TYPE", "CASE LAW HAS A TYPE OF PROCEDURE",
    "CASE LAW HAS CONCLUSIONS", "CASE LAW INTERPRETS LEGAL RESOURCE", "CASE LAW ORIGINATES IN COUNTRY", "CASE LAW ORIGINATES IN COUNTRY OR USES A ROLE QUALIFIER",
    "CASE LAW USES LANGUAGE OF PROCEDURE", "CELEX IDENTIFIER", "DATE OF DOCUMENT", "DATE OF REQUEST FOR AN OPINION", "ECLI", "LEGACY DATE OF CREATION OF WORK",
    "LEGAL RESOURCE BASED ON TREATY CONCEPT", "LEGAL RESOURCE IS ABOUT SUBJECT MATTER", "NATIONAL JUDGEMENT", "RELATED JOURNAL ARTICLE", "SECTOR IDENTIFIER",
    "WORK HAS RESOURCE TYPE", "YEAR OF THE LEGAL RESOURCE",
)
#: EU columns that pruning drops.
EU_DROPPED = (
    "WORK IS CREATED BY AGENT (AU)", "LEGAL RESOURCE USES ORIGINALLY LANGUAGE", "CASE LAW DELIVERED BY ADVOCATE GENERAL", "CASE LAW DELIVERED BY JUDGE",
    "DATE_CREATION_LEGACY", "DATETIME NEGOTIATION", "SEQUENCE OF VALUES", "NATURAL NUMBER (CELEX)", "TYPE OF LEGAL RESOURCE", "WORK CITES WORK. CI / CJ",
    "IDENTIFIER OF DOCUMENT", "WORK VERSION", "LAST CMR MODIFICATION DATE", "LEGAL RESOURCE HAS TYPE OF ACT", "REFERENCE TO PROVISIONS OF NATIONAL LAW",
    "PUBLICATION REFERENCE OF COURT DECISION", "LOCAL IDENTIFIER", "WORK TITLE", "CMR CREATION DATE", "CASE LAW DELIVERED BY NATIONAL COURT",
    "REFERENCE TO A EUROPEAN ACT IN FREE TEXT", "CASE LAW BASED ON A LEGAL INSTRUMENT", "PARTIES OF THE CASE LAW", "index",
)
EU_TYPES = ("Unknown", "Opinion of the Advocate General", "Judgment")

# --- Fixed values: linked-data terms. ---
TERMS = "http://linkeddata.overheid.nl/terms/"
LAW_PREFIX = TERMS + "bwb/id/"
CASE_PREFIX = TERMS + "jurisprudentie/id/"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
DC_TITLE = "http://purl.org/dc/terms/title"
DC_IDENTIFIER = "http://purl.org/dc/terms/identifier"
DC_TYPE = "http://purl.org/dc/terms/type"
PREF_LABEL = "http://www.w3.org/2004/02/skos/core#prefLabel"
LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
LAW_TERMS = (DC_IDENTIFIER, DC_TYPE, RDF_TYPE, TERMS + "isOnderdeelVan", TERMS + "isOnderdeelVanRegeling", DC_TITLE, PREF_LABEL, LABEL, TERMS + "heeftJuriconnect", TERMS + "heeftOnderdeelNummer")
CASE_TERMS = (DC_IDENTIFIER, DC_TYPE, RDF_TYPE, DC_TITLE, PREF_LABEL, LABEL, TERMS + "refereertAan", TERMS + "linkt", TERMS + "heeftZaaknummer", TERMS + "heeftUitspraakdatum")
#: Kinds of law elements by the last part of their type's IRI.
LAW_KINDS = ("Wet", "Deel", "Boek", "Titeldeel", "Hoofdstuk", "Artikel", "Paragraaf", "SubParagraaf", "Afdeling")
LEAST_SUBJECT = 54
LINK_SOURCES = ("lido-ref", "lido-linkt", "custom")
ALIAS_SOURCES = ("opschrift", "bwbidlist")
TITLE_LIMIT = 2500
