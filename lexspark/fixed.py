"""Fixed values.

Everything here is a constant that has to equal the published data model for the results to be
right: word lists, patterns (in Java dialect), formats, field names and defaults.

Flags used in the patterns: ``U`` Unicode classes (so ``\\s`` covers NBSP), ``i`` case-blind,
``s`` dot matches newline, ``m`` line anchors, ``d`` only ``\\n`` ends a line.
"""

# --- Unicode whitespace, as removed by strip() -------------------------------------------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# --- Wikitext -> Markdown ----------------------------------------------------------------------
PROMULGATION = "la Costituzione della Repubblica Italiana nel seguente testo:"
TOC_END = "|}"

FRONTMATTER = """\
---
tipo: COSTITUZIONE
numero: 1
data: 1947-12-27
titolo: "Costituzione della Repubblica Italiana"
urn: urn:nir:stato:costituzione:1947-12-27
codice_redazionale: 047U0001
vigente: true
fonte: https://it.wikisource.org/wiki/Italia,_Repubblica_-_Costituzione
licenza: CC BY-SA 3.0
---
"""

# Applied to the whole text, in this order.
MARKUP_RULES = [
    (r"\{\{[^}]*\}\}", ""),
    (r"(?s)\{\|.*?\|\}", ""),
    (r"\[\[([^\]|]+)(?:\|[^\]]+)?\]\]", "$1"),
    (r"(?iU)<br\s*/?>", "\n"),
    (r"(?s)<ref[^>]*>.*?</ref>", ""),
    (r"<[^>]+>", ""),
    (r"  +", " "),
]

# One heading form per line; [^\S\n] is whitespace inside the line.
HEADING_RULES = [
    (r"(?mdU)^=====[^\S\n]*(Art\.[^\S\n]*\d+[^\s]*)[^\S\n]*=====[^\S\n]*$", "## $1"),
    (r"(?mdU)^====[^\S\n]*(?!#)(.+?)[^\S\n]*====[^\S\n]*$", "### $1"),
    (r"(?mdU)^===[^\S\n]*(?!#)(.+?)[^\S\n]*===[^\S\n]*$", "## $1"),
    (r"(?mdU)^==[^\S\n]*'''(?!#)(.+?)'''[^\S\n]*==[^\S\n]*$", "# $1"),
    (r"(?mdU)^==[^\S\n]*(?!#)(.+?)[^\S\n]*==[^\S\n]*$", "# $1"),
]

BLANK_RUN = (r"\n{3,}", "\n\n")

# After the headings; the residual "=" rule runs twice on purpose (two layers).
FINISH_RULES = [
    (r"(?md)\nCategoria:.*$", ""),
    (r"(?mdU)^(#{1,4})\s*=\s*(.+?)\s*=\s*$", "$1 $2"),
    (r"(?mdU)^(#{1,4})\s*=\s*(.+?)\s*=\s*$", "$1 $2"),
    (r"(?d)'''(.*?)'''", "**$1**"),
    (r"(?d)''(.*?)''", "*$1*"),
]

COUNT_ARTICLES = r"(?md)^## Art\."
COUNT_PARTS = r"(?md)^# "

# --- Markdown segmentation ---------------------------------------------------------------------
METADATA_PREFIXES = [
    "---", "tipo:", "numero:", "data:", "titolo:", "urn:",
    "codice_redazionale:", "vigente:", "fonte:", "licenza:",
]
# Heading lines. A line that fits none of them is body text.
FINAL_PART_HEADING = "# Disposizioni"
PART_HEADING = r"#(?![^\n]*(?:Art\.|Disposizioni))[^\S\n]+([^\n]+)"
TITLE_HEADING = r"##(?![^\n]*Art\.)[^\S\n]+([^\n]+)"
PROVISION_HEADING = r"###[^\S\n]+([IVXLCDM]+)$"
SECTION_HEADING = r"###(?![^\n]*Art\.)(?![^\S\n]+[IVXLCDM]+$)[^\S\n]+([^\n]+)"
ARTICLE_HEADING = r"## Art\.[^\S\n]*(\d+[bis]?)$"
FINAL_PART = "Disposizioni transitorie e finali"
ARTICLE_LABEL = "Art. "
PROVISION_LABEL = "Disposizione transitoria "

# --- Laws: numbers in titles -------------------------------------------------------------------
TITLE_MANY = (
    r"(?iU)(?:Modifica|Modifiche|Modificazioni|Modificazione)\s+"
    r"(?:all['’]|degli|agli)\s+articol[oi]\s+"
    r"((?:\d+(?:,\s*|\s+e\s+)*)+)"
)
TITLE_ONE = r"(?iU)(?:all['’]|dell['’])articolo\s+(\d+)\s+della\s+Costituzione"
TITLE_REVISION = r"(?iU)Revisione\s+dell['’]articolo\s+(\d+)"
TITLE_WHOLE_TITLE = r"(?iU)Modifiche\s+al\s+titolo\s+([VX]+)\s+della\s+parte\s+seconda"
TITLE_RANGES = {"V": (114, 133)}

# --- Laws: numbers in bodies -------------------------------------------------------------------
BODY_HEADER = r"##\s+Art\.\s+\d"
BODY_NOTES = r"(?smdU)^Note\s.*\z"
BODY_FRONTMATTER = r"(?s)\A---.*?---\n*"
CHANGE_WORDS = [
    "sostituit", "modificat", "aggiunt", "soppress", "apportat",
    "inserit", "abrogat", "premesso",
]
ARTICLE_LINK = r"(?iU)\[([^\]]*(?:della\s+)?Costituzione[^\]]*)\]\([^)]*#art_(\d+)[^)]*\)"

# --- Laws: type --------------------------------------------------------------------------------
STATUTE_TITLES = [
    r"Statuto\s+speciale",
    r"statut[oi]\s+speciali",
    r"Statuto\s+della\s+Regione\s+siciliana",
    r"Conversione in legge costituzionale dello Statuto",
    r"Modifica\s+dell['’]articolo\s+\d+\s+dello\s+Statuto",
    r"Modifiche\s+ed\s+integrazioni\s+agli\s+statuti",
]
OTHER_LAW_TITLES = [
    "referendum", "Proroga del termine", "Cessazione degli effetti",
    "Soppressione del Senato", "Scadenza del termine",
    "Norme integrative", "Norme sui giudizi",
    "Commissione parlamentare", "Commissione per le riforme",
    "Assegnazione di tre Senatori", "Indizione di un",
]
STATUTE, OTHER_LAW, AMENDMENT = (
    "statuto_speciale", "altra_legge_costituzionale", "modifica_costituzione",
)

# --- Court outcomes ----------------------------------------------------------------------------
OUTCOME_PATTERNS = {
    "illegittimo": (
        r"(?iU)(?:dichiar[ato]*(?:\s+costituzionalmente)?\s+(?:l[']?)illegittimit[àa]\s+costituzionale"
        r"|costituzionalmente\s+illegittim)"
    ),
    "non_fondata": r"(?iU)non\s+fondat",
    "inammissibile": r"(?iU)inammissibil",
    "manifestamente_infondata": r"(?iU)manifestament",
}
NO_OUTCOME, MIXED_OUTCOME = "altro", "misto"
ACCEPTED_OUTCOME, REJECTED_OUTCOME = "illegittimo", "non_fondata"

# --- Court registers ---------------------------------------------------------------------------
CONSTITUTION_PARAMETER = "costituzione"
ARCHIVE_KINDS = {
    "Cc_Opendata_RegistroOrdinanze.zip": "ordinanza",
    "Cc_Opendata_RegistroRicorsi.zip": "ricorso",
}

# --- Enrichment and indicators -----------------------------------------------------------------
SNIPPET_CHARS = 300
DEFAULT_INDICATOR_KIND = "outcome"
MAPPING_VERSION = 1
INDICATOR_KINDS = ["outcome", "strutturale", "territoriale"]

# --- Metrics -----------------------------------------------------------------------------------
TOP_ARTICLES = 5
MIN_RULINGS = 50
