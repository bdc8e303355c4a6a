"""Word lists, patterns and thresholds that results depend on."""

from __future__ import annotations

#: What a translator is asked, with the language's name and code and the text. Fixed value.
TRANSLATION_PROMPT = (
    "Translate the following company values text from %s (%s) into English.\n\nRules:\n- Translate literally and completely.\n- Do not summarise.\n"
    "- Do not reorganise the content.\n- Do not add headings unless they exist in the source.\n- Do not explain the translation.\n"
    "- Return only the translated text.\n\nSOURCE TEXT:\n%s"
)
#: Countries that companies are kept for. Fixed values.
COUNTRIES = (
    "australia", "germany", "south africa", "brazil", "turkey", "france", "saudi arabia", "china", "japan",
    "sri lanka",
)
#: Top-level domain of each country. Fixed values.
COUNTRY_SUFFIX = {
    "australia": "au", "germany": "de", "south africa": "za", "brazil": "br", "turkey": "tr", "france": "fr",
    "saudi arabia": "sa", "china": "cn", "japan": "jp", "sri lanka": "lk",
}
#: Legal forms, no part of a name. Fixed values.
LEGAL_WORDS = (
    "ag", "bv", "co", "company", "corp", "corporation", "gmbh", "group", "holdings", "inc", "limited", "llc", "ltd",
    "nv", "plc", "pty", "sa", "sarl",
)
#: Hosts that are no company site. Fixed values.
BLOCKED_HOSTS = (
    "instagram.com", "facebook.com", "facebook.com.br", "fb.me", "linkedin.com", "twitter.com", "x.com",
    "youtube.com", "youtu.be", "tiktok.com", "linktr.ee", "lnk.bio", "campsite.bio", "instabio.cc", "bio.link",
    "wa.me", "weibo.com", "qq.com", "weebly.com", "wixsite.com", "wordpress.com", "blogspot.com", "business.site",
    "negocio.site", "sites.google.com", "g.page", "business.google.com", "medium.com", "github.com", "github.io",
    "behance.net", "vimeo.com", "soundcloud.com", "spotify.com", "anchor.fm", "ausha.co", "meetup.com",
    "calendly.com", "forms.gle", "docs.google.com", "drive.google.com", "mailchi.mp", "etsy.com", "mercadolibre",
    "1688.com", "wikipedia.org",
)
#: Endings of addresses that are files. Fixed values.
FILE_EXTENSIONS = (
    ".pdf", ".jpg", ".jpeg", ".png", ".gif", ".svg", ".webp", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx",
    ".zip", ".rar",
)
#: Size bucket of each employee range. Fixed values.
SIZE_BUCKETS = {
    "1-10": "too_small", "11-50": "small", "51-200": "small", "201-500": "small", "501-1000": "medium",
    "1001-5000": "large", "5001-10000": "enterprise", "10001+": "enterprise",
}
#: Industries of each sector. Fixed values.
SECTOR_INDUSTRIES = {
    "Agriculture, Food & Beverage": "dairy; farming; food & beverages; food production; wine and spirits",
    "Arts, Media & Entertainment": "writing and editing; animation; broadcast media; design; entertainment; fine art; media production; motion pictures and film; newspapers; online media; photography; printing; publishing; performing arts; music; computer games; museums and institutions; graphic design",
    "Automotive, Aerospace & Transportation Equipment": "automotive; aviation & aerospace; defense & space; shipbuilding",
    "Business Services & Administration": "capital markets; business supplies and equipment; executive office; facilities services; management consulting; outsourcing/offshoring; program development; staffing and recruiting",
    "Construction, Real Estate & Built Environment": "architecture & planning; building materials; civil engineering; commercial real estate; construction; real estate",
    "Consumer Goods & Retail": "apparel & fashion; consumer electronics; consumer goods; consumer services; cosmetics; furniture; luxury goods & jewelry; retail; sporting goods; supermarkets; textiles; wholesale",
    "Education & Research": "e-learning; education management; higher education; libraries; primary/secondary education; professional training & coaching; research",
    "Energy, Environment & Utilities": "environmental services; oil & energy; renewables & environment; utilities",
    "Financial Services & Insurance": "accounting; banking; financial services; insurance; investment banking; investment management; venture capital & private equity",
    "Government, Public Sector & Civic": "public policy; railroad manufacture; recreational facilities and service; government administration; government relations; international affairs; legislative office; military; political organization; think tanks; public relations and communications",
    "Healthcare & Life Sciences": "veterinary; alternative medicine; biotechnology; health, wellness and fitness; hospital & health care; medical devices; medical practice; mental health care; pharmaceuticals",
    "Hospitality, Travel & Leisure": "airlines/aviation; gambling & casinos; hospitality; leisure, travel & tourism; restaurants; sports",
    "Industrial Manufacturing & Materials": "chemicals; electrical/electronic manufacturing; glass, ceramics & concrete; industrial automation; machinery; mechanical or industrial engineering; mining & metals; packaging and containers; paper & forest products; plastics; semiconductors",
    "Information Technology & Internet": "computer & network security; computer hardware; computer networking; computer software; information services; information technology and services; internet; telecommunications; wireless; nanotechnology",
    "Legal & Justice": "judiciary; law enforcement; law practice; legal services; public safety; security and investigations",
    "Logistics, Transportation & Trade": "import and export; international trade and development; logistics and supply chain; maritime; package/freight delivery; transportation/trucking/railroad; warehousing",
    "Marketing, Communications & Events": "market research; events services; marketing and advertising; translation and localization",
    "Nonprofit, Social Services & Religion": "fund-raising; civic & social organization; individual & family services; non-profit organization management; religious institutions",
}
#: Headings that announce company values. Fixed values.
PRIMARY_HEADINGS = (
    r"\bour values?\b", r"\bcore values?\b", r"\bcompany values?\b", r"\bcorporate values?\b", r"\bshared values?\b",
    r"\borganisational values?\b", r"\borganizational values?\b", r"\bour principles?\b", r"\bcore principles?\b",
    r"\bguiding principles?\b", r"\bcompany principles?\b", r"\bour beliefs?\b", r"\bcompany beliefs?\b",
    r"\bwhat we believe\b", r"\bwhat we stand for\b", r"\bvalues? and behavio(?:u)?rs?\b", r"\bour commitments?\b",
    r"\bethical principles?\b", r"\bour culture\b", r"\bcompany culture\b", r"\bour philosophy\b",
    r"\bcompany philosophy\b", r"\bour ethos\b", r"\bcorporate ethos\b", r"\bour dna\b",
)
#: Theme bank: value headings. Fixed values.
PRIMARY_THEMES = (
    "our values", "core values", "company values", "corporate values", "our principles", "guiding principles",
    "core principles", "our beliefs", "what we believe", "what we stand for", "values and behaviours",
    "values and behaviors", "our commitments", "ethical principles", "our culture", "company culture",
    "our philosophy", "our ethos", "our DNA", "how we behave", "how we work",
)
#: Theme bank: mission and purpose headings. Fixed values.
SUPPORTING_THEMES = (
    "our mission", "company mission", "our vision", "company vision", "our purpose", "company purpose",
    "our identity",
)
#: Theme bank: links. Fixed values.
LINK_THEMES = (
    "our core values", "company core values", "corporate values", "organisational values", "organizational values",
    "company principles", "guiding principles", "core principles", "our beliefs", "company beliefs",
    "what we believe", "our purpose", "company purpose", "our mission", "company mission", "our vision",
    "company vision", "mission vision and values", "purpose mission vision and values", "our culture",
    "company culture", "workplace culture", "organisational culture", "organizational culture", "shared values",
    "values and behaviours", "values and behaviors", "our commitments", "company commitments", "ethical principles",
    "business ethics", "code of values", "principles that guide us", "what guides our decisions", "how we work",
    "how we behave", "who we are and what we stand for", "what we stand for", "our identity and values",
    "our philosophy", "company philosophy", "our ethos", "corporate ethos", "our DNA", "company DNA", "our way",
    "the way we work", "our standards", "company standards", "our foundations", "our values and culture",
    "our mission and values", "our vision and values", "our purpose and values", "our principles and values",
)
#: Theme bank: pages wanted. Fixed values.
POSITIVE_THEMES = (
    "The company explicitly explains its core values, guiding principles, beliefs, or standards that influence employee behaviour and business decisions.",
    "The page describes mission, vision, or purpose together with the organisation's values, principles, beliefs, or expected behaviours.",
    "The company presents named values such as integrity, respect, innovation, collaboration, accountability, trust, excellence, inclusion, or sustainability.",
    "The page explains the behaviours expected from employees and how the organisation's values guide everyday work.",
    "The company describes its organisational culture, shared values, workplace beliefs, and the principles that shape how people work together.",
    "The page contains a structured list of company values, each supported by an explanation, definition, example, or behavioural statement.",
    "The company explains what it stands for, what it believes in, and the principles used to guide choices and relationships with stakeholders.",
    "The organisation defines its ethical principles, commitments, or standards of conduct as part of its identity and culture.",
    "The page explains the company's philosophy, ethos, identity, or DNA in terms of values, beliefs, purpose, and expected behaviour.",
    "The company describes how its mission, purpose, vision, culture, and values connect to its long-term direction and decision-making.",
)
#: Theme bank: pages not wanted. Fixed values.
NEGATIVE_THEMES = (
    "A page advertising leadership training, management development, coaching, workshops, academies, courses, or professional education services.",
    "A page describing a commercial training programme, academy, consulting service, learning product, or customer offering.",
    "A page explaining how a service helps customers develop leadership, culture, vision, behaviours, purpose, or organisational values.",
    "The page mainly discusses corporate governance, board structure, executive oversight, committees, compliance, or shareholder responsibilities.",
    "The page mainly contains investor relations information, annual reports, financial performance, stock information, or corporate disclosures.",
    "The page mainly provides contact details, office locations, enquiry forms, phone numbers, email addresses, or customer support information.",
    "The page mainly lists jobs, vacancies, recruitment information, employee benefits, or career opportunities.",
    "The page mainly describes products, services, industries, capabilities, customer solutions, or commercial offerings.",
    "The page mainly contains news articles, press releases, media updates, events, announcements, or blog posts.",
)
#: Theme bank: sections wanted. Fixed values.
VERIFY_THEMES = (
    "The organisation explicitly states its own core values, beliefs, principles, mission, vision, purpose, or expected behaviours.",
    "This section describes what the company itself stands for and how its employees or leaders are expected to behave.",
    "This section presents the organisation's identity, culture, values, mission, vision, or guiding principles.",
)
#: Theme bank: sections not wanted. Fixed values.
REJECT_THEMES = (
    "This section describes company history, restructuring, reorganisation, business divisions, factories, milestones, anniversaries, or past events.",
    "This section describes governance structures, boards, committees, directors, reporting responsibilities, ESG governance, or oversight bodies.",
    "This section is specifically about a product specification, technical feature, equipment model, product catalogue, or service description.",
    "This section is specifically about a project, event, news story, programme, gallery, membership, or temporary initiative.",
    "This section contains legal conditions, contractual clauses, privacy terms, prices, monetary value, inventory value, or compliance declarations.",
    "This section mainly lists addresses, phone numbers, email details, office locations, staff members, executives, or organisational roles.",
    "This section mainly describes employment vacancies, job applications, career opportunities, or recruitment instructions.",
)
#: Paths that are not crawled. Fixed values.
EXCLUDED_PATHS = (
    "/contact(?:/|$)", "/privacy(?:/|$)", "/terms(?:/|$)", "/terms-of-use(?:/|$)", "/termos-de-uso(?:/|$)",
    "/legal(?:/|$)", "/login(?:/|$)", "/signin(?:/|$)", "/search(?:/|$)", "/cart(?:/|$)", "/checkout(?:/|$)",
    "/author(?:/|$)", "/tag(?:/|$)", "/category(?:/|$)", "/news(?:/|$)", "/blog(?:/|$)", "/press(?:/|$)",
    "/media(?:/|$)", "/jobs?(?:/|$)", "/careers?(?:/|$)", "/vacanc(?:y|ies)(?:/|$)", "/recruitment(?:/|$)",
    "/board-of-directors(?:/|$)", "/[^/]*management-team(?:/|$)", "/[^/]*leadership-team(?:/|$)",
    "/[^/]*board-of-directors(?:/|$)", "/[^/]*executive-committee(?:/|$)", "/corporate-governance(?:/|$)",
    "/investor-relations(?:/|$)", "/awards?(?:/|$)", "/milestones?(?:/|$)", "/clients?(?:/|$)", "/customers?(?:/|$)",
    "/partners?(?:/|$)", "/brands?(?:/|$)", "/franchises?(?:/|$)", "/groupcompanies(?:/|$)",
    "/group-companies(?:/|$)", "/team(?:/|$)", "/our-team(?:/|$)", "/people(?:/|$)", "/certifications?(?:/|$)",
    "/accreditations?(?:/|$)", "/quality-assurance(?:/|$)", "/quality(?:/|$)", "/products?(?:/|$)",
    "/services?(?:/|$)", "/solutions?(?:/|$)", "/industries?(?:/|$)", "/case-studies?(?:/|$)", "/resources?(?:/|$)",
    "/events?(?:/|$)", "/mental-health(?:/|$)", "/governance(?:/|$)", "/governanca(?:/|$)",
    "/company-profile(?:/|$)", "/noticias?(?:/|$)",
)
#: Files that are not crawled. Fixed values.
EXCLUDED_EXTENSIONS = (
    ".doc", ".docx", ".gif", ".jpeg", ".jpg", ".pdf", ".png", ".ppt", ".pptx", ".svg", ".xls", ".xlsx", ".zip",
)
#: Anchor texts that say nothing. Fixed values.
ANCHOR_NOISE = (
    "", "back", "click here", "close", "learn more", "menu", "more", "next", "previous", "read more",
    "skip to content", "skip to main content", "top",
)
#: Phrases that announce values in a text. Fixed values.
VALUE_SECTIONS = (
    r"\bour values\b", r"\bcore values\b", r"\bcompany values\b", r"\bour principles\b", r"\bguiding principles\b",
    r"\bwhat we believe\b", r"\bwhat we stand for\b", r"\bmission.{0,40}vision.{0,40}values\b",
    r"\bpurpose.{0,40}values\b", r"\bvalues and behaviours\b", r"\bvalues and behaviors\b", r"\bour philosophy\b",
    r"\bcompany philosophy\b", r"\bour culture\b", r"\bcompany culture\b",
)
#: Names of values. Fixed values.
VALUE_WORDS = (
    r"\bintegrity\b", r"\brespect\b", r"\baccountability\b", r"\bexcellence\b", r"\bcollaboration\b",
    r"\binnovation\b", r"\btrust\b", r"\binclusion\b", r"\bsustainability\b", r"\bcommitment\b", r"\bcourage\b",
    r"\bsafety\b", r"\bcitizenship\b",
)
#: Paths that promise values. Fixed values.
VALUE_PATHS = (
    "/values?(?:/|$)", "/core-values?(?:/|$)", "/our-values?(?:/|$)", "/werte(?:/|$)", "/nos-valeurs(?:/|$)",
    "/valeurs(?:/|$)", "/principles?(?:/|$)", "/beliefs?(?:/|$)", "/mission-and-values?(?:/|$)",
    "/vision-and-values?(?:/|$)", "/purpose-and-values?(?:/|$)", "/mission-vision-values?(?:/|$)",
    "/[^/]*vision-mission(?:/|$)", "/[^/]*mission-vision(?:/|$)",
)

SECTION_THEMES = PRIMARY_THEMES + SUPPORTING_THEMES
#: Sector of each industry.
INDUSTRY_SECTOR = {i.strip(): sector for sector, names in SECTOR_INDUSTRIES.items() for i in names.split(";")}
OTHER_SECTOR = "Other"
GOVERNMENT_SECTOR = "Government, Public Sector & Civic"
KNOWN_SIZES = ("small", "medium", "large", "enterprise")
#: Public suffixes of two parts under the ten countries, a subset of the public list. Fixed values.
TWO_PART_SUFFIXES = (
    "com.au net.au org.au edu.au gov.au id.au com.br net.br org.br gov.br edu.br com.cn net.cn org.cn gov.cn edu.cn "
    "co.jp or.jp ne.jp ac.jp go.jp co.za org.za net.za gov.za ac.za com.sa net.sa org.sa gov.sa edu.sa "
    "com.tr net.tr org.tr gov.tr edu.tr com.lk org.lk edu.lk gov.lk com.fr asso.fr gouv.fr co.uk org.uk ac.uk gov.uk"
).split()
#: Words of text files that stand for a missing value. Fixed values.
MISSING = ("", "NA", "N/A", "n/a", "null", "NULL", "None", "nan", "NaN", "#N/A", "#NA", "<NA>", "#N/A N/A", "-NaN", "-nan", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN")
#: Tags that hold no page text. Fixed values.
DROPPED_TAGS = ("script", "style", "noscript", "header", "footer", "nav", "form", "aside", "iframe", "svg", "button")
#: Noise and abbreviations in paths. Fixed values.
PATH_NOISE = ("index", "home", "page", "wp-content", "uploads", "assets", "attachment")
PATH_WORDS = (("co", "company"), ("abt", "about"), ("profile", "company profile"), ("vis", "vision"), ("val", "values"))

KEEP_SCORE, REVIEW_SCORE = 80, 50
PER_SIZE, PER_SECTOR, PER_COUNTRY = 25, 5, 100
MAX_DEPTH, MAX_PAGES, MAX_CHILDREN = 3, 12, 2
MIN_LINK, MIN_CONTENT, MIN_MARGIN, MIN_HEADING = 0.38, 0.42, 0.06, 0.38
HEADING_CHARS, SECTION_ITEMS, SECTION_CHARS, SECTION_MIN = 150, 30, 4000, 80
PAGE_MIN_CHARS, PAGE_MIN_WORDS, PAGE_CHARS = 300, 40, 10_000
CHUNK, OVERLAP = 1500, 250
TRANSIENT = (408, 429, 500, 502, 503, 504)
ATTEMPTS = 3
