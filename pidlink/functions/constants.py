"""Fixed values that must equal the source behaviour for results to match.

Everything here is data, stated plainly and in its natural order.
"""

# --- fixed values: URL prefixes stripped from identifiers -------------------
OPENALEX_URI = "https://openalex.org/"
DOI_URI = "https://doi.org/"
PUBMED_URI = "https://pubmed.ncbi.nlm.nih.gov/"
PMC_URI = "https://www.ncbi.nlm.nih.gov/pmc/articles/"
WIKIDATA_HTTP_URI = "http://www.wikidata.org/entity/"
WIKIDATA_HTTPS_URI = "https://www.wikidata.org/entity/"
ORCID_URI = "https://orcid.org/"
ROR_URI = "https://ror.org/"
META_URI = "https://w3id.org/oc/meta/"

# --- fixed values: API urls built by the notebook helper --------------------
OPENALEX_API = "https://api.openalex.org/"
META_API = "https://opencitations.net/meta/api/v1/metadata/"

# --- fixed values: identifier schemes ---------------------------------------
# schemes both catalogues support (coverage statistics)
MUTUALLY_SUPPORTED = ("doi", "pmid", "pmcid", "issn", "wikidata")
# lookup tables of the mapping: (entity, scheme)
INDEX_TABLES = (
    ("work", "doi"),
    ("work", "pmid"),
    ("work", "pmcid"),
    ("source", "issn"),
    ("source", "wikidata"),
)

# --- fixed values: multi-mapped Works categorisation ------------------------
# DOI version marker (category D)
VERSION_PATTERN = (
    r"(?:[\.\/]v\d{1,2}[\./])|(?:[\.\/]v\d{1,2}$)|(?:\/\d{1,2}$)|(?:[^a-zA-Z]v\d{1,2}$)"
)

# DOI prefixes of publishers/issuers hosting preprints or repository copies (category B)
PREPRINT_DOI_PREFIXES = (
    "10.1002", "10.1097", "10.1099", "10.1101", "10.1130", "10.1149", "10.1158", "10.12788",
    "10.13031", "10.1364", "10.14434", "10.1484", "10.15329", "10.17077", "10.20378", "10.20944",
    "10.21034", "10.21072", "10.21203", "10.21428", "10.21467", "10.21504", "10.2196", "10.2337",
    "10.24108", "10.24296", "10.26434", "10.26686", "10.26761", "10.31124", "10.31219", "10.31220",
    "10.31221", "10.31222", "10.31223", "10.31224", "10.31225", "10.31226", "10.31227", "10.31228",
    "10.31229", "10.31230", "10.31231", "10.31232", "10.31233", "10.31234", "10.31235", "10.31236",
    "10.31237", "10.31730", "10.31923", "10.32920", "10.32942", "10.33767", "10.33774", "10.34055",
    "10.35542", "10.35543", "10.36227", "10.37281", "10.3762", "10.38140", "10.3897", "10.46715",
    "10.47340", "10.47649", "10.48199", "10.5117", "10.51767", "10.5194", "10.53731", "10.5772",
    "10.6028", "10.7554", "10.17615", "10.6084", "10.22541", "10.5281", "10.17605", "10.48550",
)

# primary-location versions that mark a repository copy (category B)
REPOSITORY_VERSIONS = ("submittedVersion", "acceptedVersion")

# DOI suffix starts of preprint servers (category E); the fifth entry is one string on purpose
PREPRINT_STRING_CLUES = (
    "/agrirxiv",
    "/arphapreprints",
    "/arxiv",
    "/au.",
    "/chemrxiv",
    "/essoar",
    "/f1000research",
    "/gatesopenres",
    "/healthopenres /amrcopenres",
    "/hrbopenres",
    "/indiarxiv",
    "/jxiv",
    "/mitofit:",
    "/mniopenres",
    "/openresafrica",
    "/osf.io",
    "/peerj.preprints",
    "/preprints",
    "/rs.",
    "/scielopreprints",
    "/wellcomeopenres",
    "/zenodo",
    "/srxiv.",
)

# Work types that mark errata, letters, editorials, other (category F)
MINOR_WORK_TYPES = ("other", "peer-review", "editorial", "erratum", "letter")

WORK_CATEGORIES = ("A", "B", "C", "D", "E", "F", "non classified")

# --- fixed values: provenance --------------------------------------------------
PROV_PRIMARY_SOURCE = "http://www.w3.org/ns/prov#hadPrimarySource"
PROV_SPECIALIZATION_OF = "http://www.w3.org/ns/prov#specializationOf"
DATACITE_HAS_IDENTIFIER = "http://purl.org/spar/datacite/hasIdentifier"
FABIO_EXPRESSION = "http://purl.org/spar/fabio/Expression"

# RDF type URI -> Meta type label
URI_TYPE_LABELS = {
    "http://purl.org/spar/doco/Abstract": "abstract",
    "http://purl.org/spar/fabio/ArchivalDocument": "archival document",
    "http://purl.org/spar/fabio/AudioDocument": "audio document",
    "http://purl.org/spar/fabio/Book": "book",
    "http://purl.org/spar/fabio/BookChapter": "book chapter",
    "http://purl.org/spar/fabio/ExpressionCollection": "book section",
    "http://purl.org/spar/fabio/BookSeries": "book series",
    "http://purl.org/spar/fabio/BookSet": "book set",
    "http://purl.org/spar/fabio/ComputerProgram": "computer program",
    "http://purl.org/spar/doco/Part": "book part",
    "http://purl.org/spar/fabio/Expression": "",
    "http://purl.org/spar/fabio/DataFile": "dataset",
    "http://purl.org/spar/fabio/DataManagementPlan": "data management plan",
    "http://purl.org/spar/fabio/Thesis": "dissertation",
    "http://purl.org/spar/fabio/Editorial": "editorial",
    "http://purl.org/spar/fabio/Journal": "journal",
    "http://purl.org/spar/fabio/JournalArticle": "journal article",
    "http://purl.org/spar/fabio/JournalEditorial": "journal editorial",
    "http://purl.org/spar/fabio/JournalIssue": "journal issue",
    "http://purl.org/spar/fabio/JournalVolume": "journal volume",
    "http://purl.org/spar/fabio/Newspaper": "newspaper",
    "http://purl.org/spar/fabio/NewspaperArticle": "newspaper article",
    "http://purl.org/spar/fabio/NewspaperIssue": "newspaper issue",
    "http://purl.org/spar/fr/ReviewVersion": "peer_review",
    "http://purl.org/spar/fabio/AcademicProceedings": "proceedings",
    "http://purl.org/spar/fabio/Preprint": "preprint",
    "http://purl.org/spar/fabio/Presentation": "presentation",
    "http://purl.org/spar/fabio/ProceedingsPaper": "proceedings article",
    "http://purl.org/spar/fabio/ReferenceBook": "reference book",
    "http://purl.org/spar/fabio/ReferenceEntry": "reference entry",
    "http://purl.org/spar/fabio/ReportDocument": "report",
    "http://purl.org/spar/fabio/RetractionNotice": "retraction notice",
    "http://purl.org/spar/fabio/Series": "series",
    "http://purl.org/spar/fabio/SpecificationDocument": "standard",
    "http://purl.org/spar/fabio/WebContent": "web content",
}

# --- fixed values: sinks -------------------------------------------------------
ROWS_PER_FILE = 10_000
