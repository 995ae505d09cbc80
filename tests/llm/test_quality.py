"""Fertility limits of the quality rules."""

import random

import public_tokenizers

from folioflow.llm import quality

PROSE = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were her all she there would their we him been has when who will more no if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over man me even most made after also did many before must through years where much your way well down should because each just those people how too little state good very make world still own see men work long get here between both life being under never day same another know while last might us great old year off come since against go came right used take three".split()
JUNK = ("###", "&&&", "$$$", "%%%", "***")


def test_fertility_rejects_symbol_junk(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(PROSE, k=rng.randint(60, 400)))) for i in range(150)]
    rows += [(1000 + i, " ".join(w + rng.choice(JUNK) for w in rng.choices(PROSE, k=rng.randint(60, 400)))) for i in range(8)]
    rows += [(2000, None), (2001, "")]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality.judge(df, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert len(got) == len(rows) and not any(got[i]["base_failed"] for i in range(1000, 1008))
    assert not any(got[i]["kept"] for i in range(1000, 1008))
    assert sum(got[i]["kept"] for i in range(150)) >= 140
    assert not got[2000]["kept"] and not got[2001]["kept"]
