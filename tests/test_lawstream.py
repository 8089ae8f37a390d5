"""Law XML read by events."""

import tracemalloc

import pytest

from codexflow.sources import lawstream

LAW = """<?xml version="1.0"?>
<DataRoot><Result><Code>0</Code></Result><ApplData><LawNum>x</LawNum><LawFullText><Law Era="Meiji" Year="29" PromulgateMonth="04" PromulgateDay="27">
  <LawNum>試験年法律第七号</LawNum>
  <LawBody><LawTitle> 港湾灯台法 </LawTitle><TOC><Article Num="1"><ArticleTitle>no</ArticleTitle></Article></TOC>
    <MainProvision>
      <Chapter Num="1"><ChapterTitle>第一章</ChapterTitle>
        <Article Num="1"><ArticleCaption>（目的）</ArticleCaption><ArticleTitle>第一条</ArticleTitle>
          <Paragraph><ParagraphNum>1</ParagraphNum><ParagraphSentence><Sentence>灯台は、</Sentence><Sentence>A &amp; B。</Sentence></ParagraphSentence>
            <Item Num="1"><ItemTitle>一</ItemTitle><ItemSentence>雨の日</ItemSentence><Subitem1><Subitem1Sentence>特に夜</Subitem1Sentence></Subitem1></Item>
            <Item><ItemSentence>雪の日</ItemSentence></Item></Paragraph>
          <Paragraph><ParagraphNum/><Sentence>前<Ruby>灯<Rt>ひ</Rt></Ruby>後</Sentence></Paragraph></Article>
        <Article><ArticleTitle>第二条</ArticleTitle><Paragraph/></Article>
      </Chapter><Paragraph><Sentence>loose</Sentence></Paragraph>
    </MainProvision>
    <SupplProvision/>
    <SupplProvision><SupplProvisionLabel>附則</SupplProvisionLabel><Article Num="1"><Paragraph><Sentence>公布の日。</Sentence></Paragraph></Article><Paragraph><Sentence>gone</Sentence></Paragraph></SupplProvision>
    <SupplProvision AmendLawNum="試験年法律第八号"><Article><Paragraph><Sentence>改正。<![CDATA[ nothing ]]></Sentence></Paragraph></Article><Article/></SupplProvision>
    <AppdxTable><Article Num="1"><Paragraph><Sentence>apart</Sentence></Paragraph></Article></AppdxTable>
  </LawBody></Law></LawFullText></ApplData></DataRoot>"""


def article(i, no, caption, *paragraphs):
    return {"article_id": i, "article_no": no, "caption": caption, "paragraphs": [{"paragraph_no": n, "text": t} for n, t in paragraphs]}


WANTED = [
    (0, article("art_1", "第一条", "（目的）", ("1", "灯台は、\nA & B。\n1 雨の日\n1 特に夜\n雪の日"), (None, "後"))),
    (0, article("art_2", "第二条", None)),
    (1, article("suppl1_art_1", "", None, (None, "公布の日。"))),
    (2, article("suppl2_art_1", "", None, (None, "改正。"))),
]


@pytest.mark.parametrize("piece", [1, 7, 100, 1 << 20])
def test_events(piece):
    rows = list(lawstream.law_events(LAW.encode(), "L", piece))
    assert [r["place"] for r in rows] == list(range(len(rows)))
    assert [(r["provision"], r["article"]) for r in rows if r["kind"] == "article"] == WANTED
    assert [(r["provision"], r["label"], r["amend_law_num"]) for r in rows if r["kind"] == "provision"] == [(1, "附則", None), (2, None, "試験年法律第八号")]
    assert rows[-1] == {"kind": "law", "place": 6, "law_num": "試験年法律第七号", "title": "港湾灯台法", "promulgated": "1896-04-27"}


def test_documents_without_articles(spark):
    loose = "<Law><PromulgationDate>1872-12-09</PromulgationDate><LawBody><MainProvision><Paragraph><ParagraphNum/><ParagraphSentence><Sentence>布告</Sentence></ParagraphSentence></Paragraph></MainProvision></LawBody></Law>"
    raw = spark.createDataFrame([(1, loose.encode()), (2, b"<Law><LawBody>"), (3, None), (4, b""), (5, b"<Law/>"), (6, LAW.encode())], "law_id long, xml binary")
    rows = lawstream.law_rows(raw)
    heads = {r["law_id"]: (r["kind"], r["title"], r["promulgated"]) for r in rows.filter("kind in ('law', 'fault')").collect()}
    assert heads == {1: ("law", "1", "1872-12-09"), 2: ("fault", None, None), 3: ("fault", None, None), 4: ("fault", None, None), 5: ("law", "5", None), 6: ("law", "港湾灯台法", "1896-04-27")}
    found = lawstream.articles(rows).filter("law_id < 6").collect()
    assert [(r["law_id"], r["article_id"], r["article_no"], r["paragraphs"][0]["text"]) for r in found] == [(1, "art_preamble", "本則", "布告")]
    assert lawstream.paragraphs(rows).filter("law_id = 6").count() == 4


def test_memory_of_a_large_law():
    """What is held beside the bytes of the document is some articles, not the tree."""
    one = "<Article><ArticleTitle>t</ArticleTitle><Paragraph><Sentence>" + "灯台の文。" * 60 + "</Sentence></Paragraph></Article>"
    xml = f"<Law><LawBody><MainProvision>{one * 20_000}</MainProvision></LawBody></Law>".encode()
    assert len(xml) > 18_000_000
    tracemalloc.start()
    number = sum(r["kind"] == "article" for r in lawstream.law_events(xml, "L"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert number == 20_000 and peak < 5_000_000
