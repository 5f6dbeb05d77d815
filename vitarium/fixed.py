"""Strings and tables that results depend on, stated as they are."""

# --- Fixed values: record columns, in file order -----------------------------
RECORD_COLUMNS = [
    "url",
    "name",
    "dates",
    "activity",
    "biography_url",
    "biography_name",
    "biography_birth_date",
    "biography_death_date",
    "biography_activities",
    "biography_text",
    "biography_error",
]

# --- Fixed values: statement columns (record columns come first in files) -----
STATEMENT_COLUMNS = [
    "name",
    "activity",
    "item_qid",
    "source_url",
    "source_activity",
    "occupation_qid",
    "occupation_label",
    "confidence",
    "property",
    "reference_property",
    "reference_url",
]

# --- Fixed values: white space as browsers' regular expressions see it --------
WHITESPACE_BUT_SPACE = (
    r"\t\n\x{0B}\f\r\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
)
WHITESPACE = f"[ {WHITESPACE_BUT_SPACE}]"

# --- Fixed values: separators and list joiner of activity labels --------------
ACTIVITY_SEPARATORS = "|;,"
LABEL_JOINER = " | "

# --- Fixed values: selectors of the catalogue site ----------------------------
CARD = ".personItem"
CARD_NAME_LINK = ".name a"
CARD_DATES = ".dates"
CARD_ACTIVITY = ".activity a"
PAGER_LINKS = ".pages a"
PAGER_CURRENT = ".pages span"
PAGER_NEXT_LABEL = ">"
INDEX_LINKS = '.initials a, .letters a, .alphabet a, a[href*="/Search/Type,Biography/Initial,"]'
INDEX_PATH_START = "/Search/Type,Biography/Initial,"
GIVEN_NAME = '[itemprop="givenName"]'
FAMILY_NAME = '[itemprop="familyName"]'
OG_TITLE = 'meta[property="og:title"]'
BIRTH_DATE = ".birthDateText"
DEATH_DATE = ".deathDateText"
HEADER_TAGS = '.personalDataControl .black-bg a[href*="/Search/Type,Biography/Tag"]'
DESCRIPTION = '[itemprop="description"]'

# --- Fixed values: initials that have an index page of their own --------------
INITIALS = "A,Ą,B,C,Ć,D,E,F,G,H,I,J,K,L,Ł,M,N,O,Ó,P,R,S,Ś,T,U,W,Y,Z,Ź,Ż".split(",")

# --- Fixed values: linking defaults and statement properties ------------------
MIN_CONFIDENCE = 0.7
OCCUPATION_PROPERTY = "P106"
REFERENCE_PROPERTY = "P854"
QS_REFERENCE_URL = "S854"
QS_RETRIEVED = "S813"
QS_DATE_FORMAT = "'+'yyyy-MM-dd'T00:00:00Z/11'"

# --- Fixed values: score of a label against one alias -------------------------
SCORE_EQUAL = 1.0
SCORE_CONTAINED_BASE, SCORE_CONTAINED_SPAN = 0.75, 0.2
SCORE_TOKENS_BASE, SCORE_TOKENS_SPAN = 0.45, 0.35
SCORE_DIGITS = 3

# --- Fixed values: occupation vocabulary (item, label, aliases) ---------------
OCCUPATIONS = [
    ("Q36180", "pisarz", ["pisarz", "pisarka", "literat", "literatka", "prozaik", "prozaiczka"]),
    ("Q49757", "poeta", ["poeta", "poetka"]),
    ("Q482980", "autor", ["autor", "autorka"]),
    ("Q1930187", "dziennikarz", ["dziennikarz", "dziennikarka", "publicysta", "publicystka"]),
    ("Q201788", "historyk", ["historyk", "historyczka"]),
    ("Q3621491", "archeolog", ["archeolog", "archeolożka"]),
    ("Q39631", "lekarz", ["lekarz", "lekarka", "medyk", "medyczka"]),
    ("Q40348", "prawnik", ["prawnik", "prawniczka", "adwokat", "adwokatka", "radca prawny"]),
    ("Q82955", "polityk", ["polityk", "polityczka", "działacz polityczny", "działaczka polityczna"]),
    ("Q37226", "nauczyciel", ["nauczyciel", "nauczycielka", "pedagog", "pedagożka"]),
    ("Q121594", "profesor", ["profesor", "profesorka"]),
    ("Q1622272", "wykładowca akademicki", ["wykładowca", "wykładowczyni", "akademik", "akademiczka"]),
    ("Q1028181", "malarz", ["malarz", "malarka"]),
    ("Q1281618", "rzeźbiarz", ["rzeźbiarz", "rzeźbiarka"]),
    ("Q36834", "kompozytor", ["kompozytor", "kompozytorka"]),
    ("Q639669", "muzyk", ["muzyk", "muzyczka", "instrumentalista", "instrumentalistka"]),
    ("Q177220", "śpiewak", ["śpiewak", "śpiewaczka", "piosenkarz", "piosenkarka"]),
    ("Q33999", "aktor", ["aktor", "aktorka"]),
    ("Q2526255", "reżyser filmowy", ["reżyser", "reżyserka", "reżyser filmowy", "reżyserka filmowa"]),
    ("Q10800557", "działacz społeczny",
     ["działacz społeczny", "działaczka społeczna", "społecznik", "społeczniczka"]),
    ("Q42603", "duchowny", ["duchowny", "duchowna", "ksiądz", "kapłan", "zakonnik", "zakonnica"]),
    ("Q1234713", "teolog", ["teolog", "teolożka"]),
    ("Q81096", "inżynier", ["inżynier", "inżynierka"]),
    ("Q18844224", "wojskowy", ["wojskowy", "żołnierz", "oficer"]),
    ("Q901", "naukowiec", ["naukowiec", "badacz", "badaczka", "uczony", "uczona"]),
]
