"""The newest policy keeps clean texts of every script and still rejects shouting and endless words."""

from fieldwatch.llm import quality

RUSSIAN = "NASA и ESA готовят новый полёт к далёкой планете. " + " ".join(f"слово{chr(1072 + k % 32)}{chr(1072 + k // 32)} идёт" for k in range(60))
GREEK = "COVID-19 ήταν η αρχή. " + " ".join(f"λέξη{chr(945 + k % 17)}{chr(945 + k // 17)} μένει" for k in range(60))
CHINESE = "\n".join(f"第{chr(0x4E00 + k)}句说明了河边的老木匠怎样在冬天修理渔网并且给孩子们讲很长的故事，{chr(0x5E00 + k)}大家都安静地听着。" for k in range(60)) + "\nNASA COVID-19"
THAI = " ".join(f"ช่างไม้เล่านิทานเรื่องยาวให้เด็กฟังทุกคืน{chr(0x0E01 + k % 40)}{chr(0x0E01 + k // 40)}" for k in range(60))
SHOUTED = " ".join(f"LOUD{chr(65 + k % 26)}{chr(65 + k // 26)} NOISE" for k in range(60))
SHOUTED_RUSSIAN = " ".join(f"ГРОМКО{chr(1040 + k % 32)}{chr(1040 + k // 32)} ШУМ" for k in range(60))
ENDLESS = " ".join(f"{'abcdefghij' * 3}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
TEXTS = {"russian": RUSSIAN, "greek": GREEK, "chinese": CHINESE, "thai": THAI, "shouted": SHOUTED, "shouted russian": SHOUTED_RUSSIAN, "endless": ENDLESS}


def test_clean_texts_of_other_scripts_stay(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id string, text string")
    clean = {"russian", "greek", "chinese", "thai"}
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == clean
    assert {r.doc_id for r in quality.quality_report(docs, "v3").filter("kept").collect()} == clean
    rows = {r.rule: r.n_failed_alone for r in quality.ablations(quality.ledger(docs, policy="v3"), "v3").collect()}
    assert rows["capitals"] == 2 and rows["long_spaced_words"] == 1


def test_older_policies_stay_as_they_were(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert quality.mask("v2") == 127 and quality.ledger(docs).columns == [*docs.columns, *quality.MEASURES, "failures"]
    kept = lambda policy: {r.doc_id for r in quality.keep_good(docs, policy).collect()}
    assert kept("v3") == kept("v2")
