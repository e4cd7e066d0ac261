"""Fixed values.  These must stay exactly as they are for results to match
the published behaviour: word lists, patterns and keyword tables.
"""

# -- fixed values: French stop words (the standard list shipped with Spark ML's
#    StopWordsRemover for "french"), in its natural order.
FRENCH_STOPWORDS = (
    "au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma mais me même mes moi "
    "mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une "
    "vos votre vous c d j l à m n s t y été étée étées étés étant étante étants étantes suis es est "
    "sommes êtes sont serai seras sera serons serez seront serais serait serions seriez seraient étais "
    "était étions étiez étaient fus fut fûmes fûtes furent sois soit soyons soyez soient fusse fusses "
    "fût fussions fussiez fussent ayant ayante ayantes ayants eu eue eues eus ai as avons avez ont aurai "
    "auras aura aurons aurez auront aurais aurait aurions auriez auraient avais avait avions aviez "
    "avaient eut eûmes eûtes eurent aie aies ait ayons ayez aient eusse eusses eût eussions eussiez eussent"
).split()

# -- fixed values: domain stop words of the collection reports.
DOMAIN_STOPWORDS = (
    "collecte rapport materiau matériau dechet déchet lot site usine provenance source type objet "
    "collecté collectés collectée issu issus présente présent environ estimation estimé estimée "
    "poids volume masse quantite quantité kg litre cm mm non renseigné"
).split()

# -- fixed values: number + unit, glued together ("45.8 kg" -> "45.8kg").
UNIT_PATTERN = r"(\d+[\.,]?\d*)\s*(kg|g|cm|mm|m²|l|ml|%)"

# -- fixed values: contamination stems (case-insensitive search).
CONTAMINATION = "contaminat|humidit|traces?|souillé|pollué|rouille|corrodé|oxydé"

# -- fixed values: material condition patterns, checked in this order on lower-cased text.
CONDITIONS = (
    ("Brisé", "bris[ée]|cassé|fracturé|endommagé|déchiré|fissur"),
    ("Neuf", "neuf|nouveau|intact|parfait.état|excellent"),
    ("Moyen", "usé|moyen|acceptable|correct|légèrement|partielle"),
)
CONDITION_DEFAULT = "Inconnu"

# -- fixed values: plant-name patterns, tried in this order (case-sensitive, group 1).
PLANT_PATTERNS = (
    r"usine\s+([A-Z][a-zA-Z\-]+)",
    r"site\s+([A-Z][a-zA-Z\-]+)",
    r"provenance\s*[:]\s*([A-Z][a-zA-Z\-]+)",
)

# -- fixed values: lexical keywords per category, in tie-break order.
KEYWORDS = (
    ("Métal", ("métal", "métallique", "ferraille", "conducteur", "acier", "aluminium", "oxydation",
               "rouille", "fer", "cuivre", "zinc", "lourd")),
    ("Verre", ("verre", "transparent", "bris", "fragile", "vitre", "bouteille", "cristal")),
    ("Plastique", ("plastique", "pet", "hdpe", "emballage", "souple", "polymère", "pvc")),
    ("Papier", ("papier", "carton", "feuille", "journal", "cellulose", "imprimé", "cartonné")),
)

# -- fixed values: request validation rules (column, minimum, maximum) and text length.
REQUEST_RANGES = (
    ("poids", 0.0, None),
    ("volume", 0.0, None),
    ("conductivite", 0.0, 1.0),
    ("opacite", 0.0, 1.0),
    ("rigidite", 0.0, None),
)
MIN_TEXT_LENGTH = 5
