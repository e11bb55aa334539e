"""Words, patterns and constants that decide results."""

# Fields of a listing, in their order.
LISTING_FIELDS = [
    "reference_id", "price", "property_type", "location", "surface_area", "rooms", "bedrooms", "agency_name",
    "agent_name", "phone_number", "email", "coordinates", "dpe_rating", "source_url", "source_domain",
]
INFORMATIVE_FIELDS = ["price", "location", "surface_area", "rooms", "reference_id", "property_type"]
ERROR_FIELDS = ["domain", "status", "reason"]
SUMMARY_FIELDS = ["domain", "status", "listing_count", "reason", "strategy", "duration_seconds"]
REASONS = ["no_website", "no_listings_found", "site_not_reachable", "blocked_403", "dynamic_js_required", "parsing_failed"]

# URLs that are never listings.
INFO_SEGMENTS = [
    "honoraires", "mentions", "mentions-legales", "cookies", "privacy", "cgu", "cgv", "legal", "contact", "equipe",
    "team", "agences", "actualites", "blog", "article", "articles", "news", "page", "pages",
]
INFO_COMPOUNDS = ["/i/redac/"]
BAD_SCHEMES = ["mailto:", "tel:", "javascript:", "data:"]
BAD_EXTENSIONS = [".pdf", ".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".css", ".js", ".mp4", ".mp3", ".zip", ".doc", ".docx"]
SOCIAL_HOSTS = [
    "facebook.com", "instagram.com", "linkedin.com", "twitter.com", "x.com", "youtube.com", "tiktok.com", "pinterest.com", "google.com/maps", "goo.gl",
]
SEED_REJECTS = ["contact", "blog", "news", "article", "mentions-legales", "privacy", "politique"]
NON_LISTING_TERMS = [
    "contact", "a-propos", "apropos", "about", "team", "equipe", "blog", "news", "actualites", "actualite", "article", "tag", "author",
    "mentions-legales", "privacy", "politique-confidentialite", "politique", "estimation", "estimer", "vendre-nous", "recrutement",
    "emploi", "carriere", "agences", "agence", "cookies", "newsletter", "estimez-votre-bien", "estimer-mon-bien", "evaluer-mon-bien",
    "vendre-mon-bien", "louer-mon-bien", "mettre-en-location", "mettre-en-vente", "deposer-une-annonce", "prendre-rendez-vous",
]

# Index pages.
HUB_PATHS = [
    "/", "/lots", "/lot", "/search", "/recherche", "/result", "/results", "/buy", "/listing-categorie", "/produits/all", "/biens/result",
    "/resultat.php", "/annonces", "/biens", "/proprietes", "/properties", "/fr/ventes", "/fr/locations", "/ventes", "/locations",
]
HUB_PATTERN = (
    "(?i)(achat-immobilier|vente-immobilier|listing-categorie|prix-m2|prix-rues|/search(?:/|$)|/recherche(?:/|$)|/result(?:/|$)|/results(?:/|$)|/biens/result|"
    "/produits/all|^/annonces/?$|^/annonce/?$|^/proprietes/?$|^/properties/?$|listing-vente\\.html|listing-location\\.html)"
)
#: Of these every index page's URL holds one.
HUB_WORDS = ["-immobilier", "listing-", "prix-", "/search", "/recherche", "/result", "/produits/all", "/annonce", "/propriete", "/properties"]
HUB_REASONS = ["hub_path", "hub_pattern", "pagination_index"]
PAGE_TAIL = "^[0-9]{1,3}$"
REFERENCE_TAIL = "(?i)(?:-vp[0-9]+|-vm[0-9]+|,[A-Z]{1,3}[0-9]+|/[0-9]{4,}|ref-?[0-9]+)\\s*$"

# Signals for a listing's page.
POSITIVE_TERMS = [
    "listing", "listings", "lots", "lot", "biens", "bien", "vente", "ventes", "buy", "property", "properties", "propriete", "proprietes",
    "produit", "produits", "maison", "maisons", "appartement", "appartements", "villa", "villas", "terrain", "terrains", "studio", "garage",
    "parking", "loft", "duplex", "chalet", "chateau", "immeuble", "detail", "details", "annonce", "location", "locations",
]
REFERENCE_HINT = "(?i)(ref-?[a-z0-9]{3,}|reference[-_=][a-z0-9]{3,}|id[-_=][0-9]{3,}|-vp[0-9]{3,}|-vm[0-9]{3,}|/[0-9]{6,}(?:[/?,]|$)|/[a-z0-9-]{12,}-[0-9]{3,}(?:[/?]|$))"
QUERY_HINT = "(?i)(page=|rooms=|budget=|zipcode=|loc=vente|type=all|piece|chambre)"
QUERY_WORDS = ["page=", "rooms=", "budget=", "zipcode=", "loc=vente", "type=all", "piece", "chambre"]
T_HINT = "(?i)\\bt[0-9]\\b"
BARE_TAILS = [
    "maison", "maisons", "appartement", "appartements", "villa", "villas", "terrain", "terrains", "studio", "studios", "loft", "lofts",
    "garage", "garages", "parking", "parkings", "local", "locaux", "bureau", "bureaux", "immeuble", "immeubles", "chalet", "chalets",
    "chateau", "chateaux", "duplex", "ferme", "fermes", "hotel", "hotels", "moulin", "moulins",
]

# sites' families as name, host patterns, markers in HTML, URL patterns, index paths.
FAMILIES = [
    ("nestenn", ["\\bnestenn\\.com$", "\\.nestenn\\.com$"], ["nestenn"], ["-ref-[0-9]{6,}", "/(?:vente|location)/.+-ref-[0-9]+"], ["/agences/"]),
    ("stephane_plaza", ["stephaneplazaimmobilier\\.com$", "\\.stephaneplazaimmobilier\\.com$"], ["stephane[\\s_-]?plaza"], ["/biens?/(?:vente|location)/[^/]+/[^/]+", "/annonce[s]?/"], ["/agences/", "/nos-agences/"]),
    ("guy_hoquet", ["guy-hoquet\\.com$", "\\.guy-hoquet\\.com$"], ["guy[\\s_-]?hoquet"], ["/biens?/(?:vente|location)/", "/annonce[s]?/"], ["/agences/"]),
    ("laforet", ["laforet\\.com$", "\\.laforet\\.com$"], ["laforet"], ["/(?:acheter|louer)/[^/]+/[^/]+", "/annonce[s]?/"], ["/agences-immobilieres/"]),
    ("era", ["erafrance\\.com$", "\\.erafrance\\.com$", "era[a-z0-9-]+\\.(?:com|fr)$"], ["era\\s+immobilier", "era[\\s-]?france"], ["/acheter/", "/annonce[s]?/", "-ref-?[0-9]{4,}"], ["/agences/"]),
    ("century21", ["century21\\.fr$", "\\.century21\\.fr$"], ["century\\s*21"], ["/trouver_logement/", "/annonce[s]?/detail/", "-fp[0-9]{4,}"], ["/agences/"]),
    ("orpi", ["orpi\\.com$", "\\.orpi\\.com$"], ["\\borpi\\b"], ["/annonce[s]?-(?:vente|location)/", "/biens-(?:vente|location)/"], ["/agences/"]),
    ("apimo", [], ["apimo", "data-apimo", "/apimo/"], ["/(?:vente|location)/[a-z0-9-]+-[0-9]{4,}", "/biens?/[a-z0-9-]+-[0-9]{4,}"], []),
    ("hektor_pericles", [], ["hektor", "laboiteimmo", "pericles", "periscope"], ["/(?:lot|bien|annonce)s?/[0-9]{3,}", ",[A-Z]{1,3}[0-9]{3,}(?:[/?]|$)", "-vp[0-9]+", "-vm[0-9]+"], []),
]
FAMILY_BOOST = 3

# Pages that are rendered by scripts.
STRONG_DYNAMIC = "(?i)(window\\.__NUXT__|window\\.__NEXT_DATA__|id=\"__next\"|data-react-helmet|ng-app=|cf-browser-verification|challenge-platform)"
WEAK_DYNAMIC = "(?i)(<noscript[^>]*>\\s*(?:you|enable javascript)|id=[\"']app[\"'][^>]*></div>)"
STRUCTURE = "(?i)<(?:main|article|section)\\b"
BODY = "(?is)<body[^>]*>(.{200,})</body>"
HEAD_CHARS, LEAST_TEXT = 65_536, 400

# Failures.
NETWORK_NAMES = ["timeout", "connect", "network", "dns"]
NETWORK_MESSAGES = [
    "connect", "timeout", "timed out", "dns", "name or service", "econnrefused", "unreachable", "reset", "closed", "ssl", "certificate", "handshake", "remote disconnected",
]
SCRIPT_MESSAGES = ["navigation", "execution context", "detached", "frame was"]
BLOCKS_TO_TRIP = 3

# Property types as canonical name, rank, synonyms; and URL segments in their order.
PROPERTY_TYPES = [
    ("maison", 1, ["maisons", "maison"]), ("appartement", 1, ["appartements", "appartement"]), ("villa", 1, ["villas", "villa"]),
    ("studio", 1, ["studios", "studio"]), ("duplex", 1, ["duplex"]), ("loft", 1, ["lofts", "loft"]), ("chalet", 1, ["chalets", "chalet"]),
    ("chateau", 1, ["chateaux", "chateau"]), ("moulin", 1, ["moulins", "moulin"]), ("ferme", 1, ["fermes", "ferme"]),
    ("immeuble", 2, ["immeubles", "immeuble"]),
    ("local commercial", 3, ["local commercial", "locaux commerciaux"]), ("bureau", 3, ["bureaux", "bureau"]), ("hotel", 3, ["hotels", "hotel"]),
    ("garage", 4, ["garages", "garage"]), ("parking", 4, ["parkings", "parking"]), ("local", 4, ["locaux", "local"]),
    ("terrain", 5, ["terrains", "terrain"]),
]
PROPERTY_SEGMENTS = [
    ("/(?:vente|location)s?-pro/[^/]*/bureaux\\b", "bureau"), ("/(?:vente|location)s?-pro/[^/]*/locaux\\b", "local"), ("/(?:vente|location)s?-pro/[^/]*/(?:entrepots?|commerces?|fonds-de-commerce)\\b", "local commercial"),
    ("/(?:vente|location)s?-pro/[^/]*/garages?\\b", "garage"), ("/(?:vente|location)s?-pro/[^/]*/parkings?\\b", "parking"), ("/(?:vente|location)s?-pro/[^/]*/immeubles?\\b", "immeuble"),
    ("/ventes?-maisons?\\b", "maison"), ("/ventes?-appartements?\\b", "appartement"), ("/ventes?-villas?\\b", "villa"), ("/ventes?-studios?\\b", "studio"),
    ("/ventes?-immeubles?\\b", "immeuble"), ("/ventes?-terrains?\\b", "terrain"), ("/ventes?-locaux\\b", "local"), ("/ventes?-bureaux\\b", "bureau"),
    ("/ventes?-garages?\\b", "garage"), ("/ventes?-parkings?\\b", "parking"), ("/locations?-maisons?\\b", "maison"), ("/locations?-appartements?\\b", "appartement"),
    ("/(?:vente|location)/[0-9]*-?[a-z\\-]+/maisons?(?:/|$)", "maison"), ("/(?:vente|location)/[0-9]*-?[a-z\\-]+/appartements?(?:/|$)", "appartement"), ("/(?:vente|location)/[0-9]*-?[a-z\\-]+/villas?(?:/|$)", "villa"), ("/(?:vente|location)/[0-9]*-?[a-z\\-]+/terrains?(?:/|$)", "terrain"),
    ("/(?:vente|location)/[0-9]*-?[a-z\\-]+/bureaux\\b", "bureau"), ("/(?:vente|location)/[0-9]*-?[a-z\\-]+/locaux\\b", "local"), ("/(?:vente|location)/[0-9]*-?[a-z\\-]+/(?:entrepots?|commerces?|fonds-de-commerce)\\b", "local commercial"),
    ("/(?:vente|location)/[0-9]*-?[a-z\\-]+/garages?\\b", "garage"), ("/(?:vente|location)/[0-9]*-?[a-z\\-]+/parkings?\\b", "parking"),
]

#: How all of these begin.
SEGMENT_HEAD = "/(?:vente|location)(?:s?-|/[^/]*/)"

# Prices.
PER_AREA = "(?i)((?:€|eur|euro[s]?)\\s*(?:/|par)\\s*m\\s*[²2]|prix\\s*(?:au|/|-)\\s*m\\s*[²2]|prix-rues|cost\\s*per\\s*m\\s*[²2])"
ON_REQUEST = "(?i)(sur\\s+demande|on\\s+request|prix\\s+sur\\s+demande|nous\\s+consulter)"
RENT = "(?i)(loyer(?:\\s+(?:mensuel|charges))?|/\\s*mois|par\\s+mois|monthly\\s+rent|charges?\\s+comprises|honoraires?\\s+(?:de\\s+)?location)"
SALE = "(?i)(vente|achat|[àÀ]\\s+vendre|a\\s+vendre|prix\\s+de\\s+vente|\\bfai\\b|net\\s+vendeur|honoraires?\\s+(?:d['’]?|de\\s+)?(?:vente|charge\\s+vendeur|charge\\s+acqu[éÉe]reur)|\\bprice\\b|sale\\s+price)"
CURRENCY_OR_LABEL = "(?i)(€|\\beur(?:o|os)?\\b|\\bprix\\b|\\bprice\\b)"
PRICE_LABEL = "(?i)(?:prix(?:\\s+de\\s+vente)?|price)\\s*[:\\-]?\\s*([^\\n\\r<]{2,60})"
EURO_AMOUNT = "([0-9][0-9\\s\\x{a0}.,]*)\\s*€"
PRICE_SELECTORS = [
    "[itemprop='price']", "[data-price]", "[data-price-value]", "[data-price-amount]", "meta[itemprop='price']", ".price", ".prix", ".bien-prix", ".property-price", ".listing-price",
]
PRICE_ATTRIBUTES = ["content", "data-price", "data-price-value", "data-price-amount"]
LEAST_PRICE, MOST_PRICE, SMALL_DIGITS, AROUND = 1_000, 50_000_000, 4, 120

# Surface, rooms, bedrooms, energy class.
SURFACE_LABEL = "(?i)(?:surface(?:\\s+habitable)?|superficie|living\\s+area)\\s*[:\\-]?\\s*([0-9][0-9\\s\\x{a0}.,]*)\\s*m\\s*[²2]"
SURFACE_LOOSE = "(?i)([0-9][0-9\\s\\x{a0}.,]*)\\s*m\\s*[²2]"
ROOMS = "(?i)(?:pi[èÈe]ces?|rooms?)\\s*[:\\-]?\\s*([0-9]{1,2})|([0-9]{1,2})\\s*(?:pi[èÈe]ces?|rooms?)"
BEDROOMS = "(?i)(?:chambres?|bedrooms?)\\s*[:\\-]?\\s*([0-9]{1,2})|([0-9]{1,2})\\s*(?:chambres?|bedrooms?)"
T_ROOMS = "(?i)\\bT([0-9]{1,2})\\b"
DPE_LABELS = [
    "(?i)\\bdpe(?:\\s+collectif)?\\b\\s*[:\\-]?\\s*(?:classe\\s*)?([A-G])\\b",
    "(?i)\\bdiagnostic(?:\\s+de\\s+performance)?(?:\\s+energetique)?\\b\\s*[:\\-]?\\s*(?:classe\\s*)?([A-G])\\b",
    "(?i)\\b(?:classe(?:ment)?|etiquette)(?:\\s+energie|\\s+energetique)?\\b\\s*[:\\-]?\\s*([A-G])\\b",
    "(?i)\\bconsommation(?:\\s+energetique)?\\b\\s*[:\\-]?\\s*([A-G])\\b",
]
DPE_WORDS = [["dpe"], ["diagnostic"], ["class", "etiquette"], ["consommation"]]
DPE_ATTRIBUTES = ["data-dpe", "data-classe-energie", "data-classe-dpe", "data-energy-class", "data-energie"]
DPE_ALT = "(?i)(?:dpe|etiquette\\s+energie|classe\\s+energie)[\\s\\-:]*(?:lettre\\s+)?([A-G])\\b"
DPE_CLASS = "(?i)(?:^|[\\s\\-_])(?:dpe|classe|class|letter|lettre|energy)[\\s\\-_]?([A-G])(?:[\\s\\-_]|$)"
DPE_SCOPE = "[class*='dpe' i], [class*='energie' i], [class*='energy' i], [class*='etiquette' i]"

# References.
REFERENCE_LABELS = [
    "(?i)(?:r[éÉe]f(?:[éÉe]rence)?|r[éÉ]f\\.?|ref\\.?|n°\\s*id)\\s*[:#\\.\\-]?\\s*([A-Za-z0-9][A-Za-z0-9_\\-/]{2,})\\b",
    "(?i)(?:^|\\b)id\\s*[:#\\.\\-]?\\s*([A-Za-z0-9][A-Za-z0-9_\\-/]{2,})\\b",
]
REFERENCE_CODE = "\\b([A-Z]{1,3}[0-9]{3,})\\b"
REFERENCE_TAILS = ["(?i)-ref-?([0-9]{4,})(?:[/?,]|$)", "(?i)-fp([0-9]{4,})(?:[/?,]|$)", ",([A-Za-z]{1,3}[0-9]{3,})(?:[/?,]|$)"]
IDENTIFIER = "[0-9]|[A-Z][a-z]|[a-z][A-Z]|[-_/]"
NAV_ROOT, ACRONYM = "^[a-z]{1,5}$", "^[A-Z]{2,}[-_/0-9]"
MOST_HYPHENS, LONGEST_SLUG = 3, 30
JUNK_TOKENS = [
    "partager", "facebook", "twitter", "linkedin", "share", "search", "result", "results", "page", "trouv", "aucun", "recherche", "liste", "user",
    "immobili", "estimation", "estimer", "prix-m2", "prix-rues", "location", "locations", "vente", "ventes", "annonce", "annonces", "contact",
    "contactez", "equipe", "agence", "agences", "team", "blog", "news", "actualite", "actualites", "article", "login", "connexion", "inscription",
    "register", "mentions", "privacy", "politique", "cookies", "plan-du-site", "sitemap", "newsletter", "recrutement", "emploi", "carriere",
    "accueil", "home", "about", "a-propos", "accession", "personnaliser", "copropriete", "bailleurs", "vendeurs", "acquereurs", "acheteurs",
    "mandataire", "locataires", "mes-biens", "mes-alertes", "mes-favoris", "mon-compte", "mon-espace", "espace-client", "financement", "simulateur",
    "simulation", "taux", "reglementation", "environnementale", "d-architecture", "hqe", "habitat-durable", "choisir", "realiser", "reception",
    "parrainage", "taxe", "vendre", "estimez-votre-bien", "estimez", "estimer-mon-bien", "evaluer-mon-bien", "evaluation", "mettre-en-location",
    "mettre-en-vente", "mettre-en", "vendre-mon-bien", "vendre-son-bien", "acheter-un-bien", "louer-un-bien", "deposer-une-annonce",
    "poster-une-annonce", "prendre-rendez-vous", "rendez-vous", "demande-de-rappel", "rappelez-moi", "rappel-immediat", "transaction",
]
UI_VERBS = [
    "mettre", "estimez", "estimer", "evaluer", "evaluez", "vendre", "vendez", "acheter", "achetez", "louer", "louez", "contacter", "contactez",
    "demander", "demandez", "deposer", "deposez", "poster", "prendre", "rappeler", "rappelez", "calculer", "calculez", "simuler", "simulez",
    "choisir", "choisissez", "trouver", "trouvez", "reserver", "reservez", "signaler", "signalez",
]

# Phones and e-mail addresses.
PHONE_LABELS = [
    "(?i)(?:t[éÉe]l(?:[éÉe]phone)?|phone|portable|mobile)\\s*[:\\-]?\\s*((?:\\+|00)?[0-9][0-9\\s().\\-]{7,})",
    "(?i)((?:\\+|00)?[0-9][0-9\\s().\\-]{7,})\\s*(?:t[éÉe]l(?:[éÉe]phone)?|phone)",
]
PHONE_FREE = "((?:0|\\+33|0033)[\\s.\\-]?[1-9](?:[\\s.\\-]?[0-9]{2}){4})"
EMAIL = "[A-Za-z0-9._%+\\-]{1,64}@[A-Za-z0-9.\\-]{1,253}\\.[A-Za-z]{2,24}"
OBFUSCATED = "(?i)([A-Za-z0-9._%+\\-]{1,64})\\s*[\\[(]\\s*\\bat\\b\\s*[\\])]\\s*([A-Za-z0-9.\\-]{1,64})\\s*[\\[(]\\s*\\bdot\\b\\s*[\\])]\\s*([A-Za-z]{2,8})"
#: What comes before the first bracket of such an address, read backwards.
OBFUSCATED_RUN = "^\\s*[A-Za-z0-9._%+\\-]{0,64}"
OBFUSCATED_MARK = "(?i)[\\[(]\\s*at\\b"
EMAIL_REJECTS = [".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", "x320", "x640", "x1024", "sentry", "example.com"]
OBFUSCATED_CHARS, EMAIL_CHARS = 32_000, 256_000

# Places.
_COMMUNE = "[A-ZÀ-Ý][\\wÀ-ÿ'\\-]{1,30}(?:[ \\-][A-ZÀ-Ý][\\wÀ-ÿ'\\-]{1,30}){0,3}"
URL_POSTAL = "(?i)(?:^|[/\\-])([a-z][a-z0-9\\-]{2,})-(\\d{5})(?:[/,?\\-]|$)|(?:^|[/\\-])(\\d{5})-([a-z][a-z0-9\\-]{2,})(?:[/,?\\-]|$)"
TITLE_AT = f"(?:[\\s»])(?:à|a|au|aux|at)\\s+({_COMMUNE})"
TITLE_POSTAL_FIRST = f"\\b(\\d{{5}})\\s+({_COMMUNE})\\b"
TITLE_POSTAL_LAST = f"\\b({_COMMUNE})\\s*\\(?(\\d{{5}})\\)?\\b"
BODY_POSTAL = f"\\b({_COMMUNE})\\s+(\\d{{5}})\\b"
BODY_CHARS = 32_768
BREADCRUMB = ".breadcrumb, .breadcrumbs, nav.breadcrumb, ol.breadcrumb, ul.breadcrumb, [itemtype*='BreadcrumbList'], [class*='breadcrumb' i], [class*='chemin' i]"
AGENT_BREADCRUMB = ".breadcrumb, .breadcrumbs, [class*='breadcrumb' i]"
PLACE_METAS = ["meta[property='og:locality']", "meta[property='place:location:locality']", "meta[name='geo.placename']"]
DETAIL_URL = "(?i)(?:/\\d{5,}|-vp\\d{3,}|-vm\\d{3,}|/[a-z0-9-]{12,}-\\d{3,}|,[A-Z]{1,3}\\d{3,})"
DESCRIPTOR = "(?i)€|eur(?:o|os)?|/\\s*mois|par\\s+mois|m\\s*[²2]|\\bm2\\b"
SLUG_DESCRIPTOR = "(?i)€|^\\d+[a-z]?[²2]?$|\\bm2\\b|m\\s*[²2]|mois|^\\d+e$"
URL_CATEGORIES = ["vente", "ventes", "location", "locations", "biens", "bien", "annonce", "annonces", "acheter", "louer", "vente-pro", "location-pro"]
PROPERTY_TOKENS = BARE_TAILS
NAV_LABELS = [
    "maison", "maisons", "appartement", "appartements", "villa", "villas", "terrain", "terrains", "studio", "studios", "garage", "garages",
    "parking", "parkings", "loft", "chalet", "chateau", "immeuble", "local", "bureau", "bureaux", "hotel", "ferme",
    "vente", "ventes", "location", "locations", "a vendre", "a louer", "acheter", "louer", "buy", "rent", "achat",
    "annonce", "annonces", "biens", "bien", "propriete", "proprietes", "property", "properties", "liste", "detail", "details", "page", "resultats", "results",
    "accueil", "home", "contact", "agence", "agences", "equipe", "team", "actualites", "blog", "recherche", "search", "estimer", "estimation",
    "financement", "simulateur", "simulation", "taux",
    "bailleurs", "vendeurs", "acquereurs", "acheteurs", "locataires", "mandataire", "mandataires", "immobilier", "immobiliere",
    "mes biens", "mes alertes", "mes favoris", "mes recherches", "mon compte", "mon espace", "espace client", "espace candidat", "connexion",
    "se connecter", "deconnexion", "inscription", "dashboard", "bienvenue",
    "transaction", "transactions", "decouvrir", "decouvrez", "voir", "voir plus", "voir tous", "voir tout", "tous les biens", "tous nos biens",
    "derniers biens", "nouveautes", "nouveaute", "coup de coeur", "coups de coeur", "exclusivites", "exclusivite", "selection", "selections",
    "nos biens", "nos selections", "nos exclusivites", "nos coups", "best of", "top", "top biens",
    "vacances", "location vacances", "location saisonniere", "neuf", "programme", "programmes", "programme neuf", "programmes neufs", "dispositif",
    "dispositifs", "aide", "aides", "investir", "investissement", "defiscalisation", "estimez", "evaluez", "evaluer", "estimez votre bien",
    "vendre mon bien", "louer mon bien", "chambres", "chambre", "pieces", "piece", "neuve", "neuves", "neufs", "sale", "house", "for sale",
]

# Coordinates.
_FLOAT = "[+-]?\\d{1,3}(?:\\.\\d+)?"
LAT_KEY = f"(?i)(?:\"|\\b)(?:lat|latitude)(?:\"|\\b)\\s*[:=]\\s*({_FLOAT})"
LNG_KEY = f"(?i)(?:\"|\\b)(?:lng|lon|long|longitude)(?:\"|\\b)\\s*[:=]\\s*({_FLOAT})"
MAPBOX = f"center\\s*:\\s*\\[\\s*({_FLOAT})\\s*,\\s*({_FLOAT})\\s*\\]"
LEAFLET = [f"L\\.(?:marker|latLng)\\(\\s*\\[?\\s*({_FLOAT})\\s*,\\s*({_FLOAT})\\s*\\]?", f"setView\\(\\s*\\[\\s*({_FLOAT})\\s*,\\s*({_FLOAT})\\s*\\]"]
MAP_URLS = [f"[?&]ll=({_FLOAT}),({_FLOAT})", f"[?&]q=({_FLOAT}),({_FLOAT})", f"/@({_FLOAT}),({_FLOAT})"]
PAIR = f"^\\s*({_FLOAT})\\s*,\\s*({_FLOAT})\\s*$"
LAT_ATTRIBUTES, LNG_ATTRIBUTES = ["data-lat", "data-latitude"], ["data-lng", "data-lon", "data-long", "data-longitude"]
PAIR_ATTRIBUTES = ["data-coords", "data-coord", "data-position", "data-latlng", "data-latlong", "data-geo"]
LAT_METAS = ["meta[property='og:latitude']", "meta[property='place:location:latitude']"]
LNG_METAS = ["meta[property='og:longitude']", "meta[property='place:location:longitude']"]
POSITION_META = "meta[name='geo.position']"

# Agents.
AGENT_SELECTORS = [
    "[itemprop='salesAgent']", "[itemprop='author']", "[data-agent-name]", "[data-agent]", "[data-conseiller]", "[data-negociateur]",
    ".agent-card .name", ".agent-card__name", ".agent-name", ".agent-info .name", ".property-agent .name", ".contact-card .name", ".contact-card__name",
    ".contact-bien .name", ".contact-bien__name", ".bloc-contact .name", ".card-contact .name", ".author-card .name", ".fiche-contact .name",
    ".fiche-contact__name", ".team-member-name", ".team-member .name", ".bien-contact .name", ".bien-agent .name", ".bien-card .name",
    ".commercial-name", ".consultant-name", ".negociateur-name", ".negociateur .name", ".conseiller-name", ".conseiller .name", ".responsable .name",
    ".referent .name", ".intervenant .name", ".expert-immobilier .name", ".signature .name", ".signature-author", ".author .name",
    "[itemprop='name'][itemtype*='Person']", "[itemprop='name'][itemtype*='RealEstateAgent']",
]
AGENT_ATTRIBUTES = ["data-agent-name", "data-agent", "data-conseiller", "data-negociateur", "content"]
AGENT_CONTEXT = [
    "agent", "agents", "team", "equipe", "contact-card", "contact_card", "contact-info", "contact_info", "property-agent", "property_agent",
    "bien-contact", "bien_contact", "bien-agent", "bien_agent", "negociateur", "conseiller", "commercial", "sales-agent", "salesperson",
    "fiche-contact", "fiche_contact", "contact-bien", "contact_bien", "bloc-contact", "bloc_contact", "card-contact", "card_contact", "author-card",
    "author_card", "agent-card", "agent_card", "bien-card", "bien_card", "agent-info", "agent_info", "signature", "signature-author",
    "signature_author", "responsable", "referent", "intervenant", "expert", "expert-immobilier", "expert_immobilier", "consultant", "proprietaire",
    "vendeur", "agent-immobilier", "agent_immobilier", "nego", "author",
]
AGENT_DEPTH, LONGEST_NAME = 5, 80
_ROLE = (
    "agent(?:\\s+immobilier)?|n[ée]gociateur|conseiller(?:\\s+immobilier)?|commercial|consultant(?:\\s+immobilier)?|expert(?:\\s+immobilier)?|"
    "responsable\\s+du\\s+bien|votre\\s+(?:conseiller|n[ée]gociateur|contact)|mandataire(?:\\s+immobilier)?|referent"
)
_NAME = "(?:M(?:me|lle|\\.)?\\s+|Mme\\s+|Mlle\\s+)?[A-ZÀ-Ý][\\wÀ-ÿ'\\-]+(?:\\s+[A-ZÀ-Ý][\\wÀ-ÿ'\\-]+){1,3}"
AGENT_LABELS = [f"(?i)(?:{_ROLE})\\s*[:\\-–—]?\\s*({_NAME})", f"(?i)({_NAME})\\s*[\\-–—,]\\s*(?:{_ROLE})\\b"]
HONORIFIC = "(?i)^(?:m\\.|mme|mlle|monsieur|madame|mademoiselle)\\s+"
NAME_SHAPES = ["^[A-ZÀ-Ý][\\wÀ-ÿ'\\-]+(?:\\s+[A-ZÀ-Ý][\\wÀ-ÿ'\\-]+){1,3}$", "^(?:[A-ZÀ-Ý][\\wÀ-ÿ'\\-]+\\s+)?[A-ZÀ-Ý]{2,}(?:[\\-' ][A-ZÀ-Ý]{2,})*$"]
NAME_JUNK = [
    "contact", "contactez", "appeler", "appelez", "agence", "votre conseiller", "votre negociateur", "votre contact", "nous joindre",
    "nous contacter", "telephone", "hotline", "service", "email", "horaires", "ouvert", "footer", "newsletter", "abonnez", "abonner", "independant",
    "reseau", "mandataire", "rechercher", "recherche", "mon espace", "espace client", "connexion", "se connecter", "connectez", "menu", "accueil",
    "bienvenue", "formulaire", "envoyer", "valider", "rappel", "rappelez", "callback", "call back", "toutes nos agences", "trouver une agence",
    "plan du site", "mentions legales", "politique", "cookies", "estimer", "estimation", "simulateur", "financement", "deconnexion", "inscription",
]

# JSON-LD types and keys, lower-cased.
LD_LISTING_TYPES = ["product", "realestatelisting", "singlefamilyresidence", "house", "apartment", "accommodation", "residence", "realestate"]
LD_AGENT_TYPES = ["realestateagent", "person"]
LD_PRICES = ["price", "lowprice", "highprice", "pricevalue"]
LD_REFERENCES = ["sku", "productid", "identifier", "ref", "reference", "reference_id"]
LD_PHONES = ["telephone", "phone", "phonenumber"]
LD_DPE = ["energyefficiencycategory", "energyclass", "energyrating", "dperating", "epcrating", "epccategory"]
LD_AGENT_PARENTS = ["author", "seller", "publisher", "provider", "agent"]

# Places of sitemaps, their line in robots.txt, and words in the URLs of those that list listings.
SITEMAP_PATHS = ["/sitemap.xml", "/sitemap_index.xml", "/sitemap-index.xml"]
SITEMAP_LINE = "(?im)^\\s*sitemap\\s*:\\s*(\\S+)"
SITEMAP_LOC = r"(?is)<loc(?:\s[^>]*)?>((?:<!\[CDATA\[.*?\]\]>|[^<])*)</loc\s*>"
LISTING_HINT = "(?i)(annonce|annonces|vente|location|bien|biens|property|properties|listing|listings|maison|appartement|achat|propriete|immobilier)"
