from maillage.functions.expressions import (  # noqa: F401
    array_remainder,
    array_slice_tail,
    array_union_clean,
    departement_of_insee,
    empty_json_to_null,
    greatest_floor,
    label_enveloppes,
    net_v2,
    normalise_activity_type,
    nom_complet,
    periode_of_date,
    zero_if_null,
)
from maillage.functions.text import trigram_code, trigram_similarity, trigrams  # noqa: F401
