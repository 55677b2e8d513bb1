"""The four record types, in output column order."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()
_LIST = T.ArrayType(_S)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


BOOK = _schema(
    ("judul", _S), ("harga", _S), ("rating", _I), ("tersedia", _B), ("kategori", _S), ("url", _S))

ARTICLE = _schema(
    ("judul", _S), ("ringkasan", _S), ("kategori", _LIST), ("url", _S), ("kedalaman", _I),
    ("jumlah_kata", _I), ("link_terkait", _LIST))

BOOK_STRUCTURE = _schema(
    ("tipe", _S), ("nama", _S), ("url", _S), ("url_induk", _S), ("kedalaman", _I),
    ("jumlah_buku", _I), ("jumlah_halaman", _I), ("nomor_halaman", _I),
    ("tag_navigasi", _LIST), ("link_anak", _LIST),
    ("meta_html", _schema(("title", _S), ("meta_description", _S), ("breadcrumb", _S),
                          ("jumlah_artikel_di_halaman", _I))))

WIKI_STRUCTURE = _schema(
    ("judul", _S), ("url", _S), ("url_induk", _S), ("kedalaman", _I),
    ("jumlah_link_internal", _I), ("jumlah_link_eksternal", _I),
    ("link_keluar", _LIST), ("link_masuk_dari", _S),
    ("jumlah_section", _I), ("judul_section", _LIST),
    ("ada_infobox", _B), ("ada_toc", _B), ("jumlah_gambar", _I), ("jumlah_referensi", _I),
    ("kategori", _LIST), ("jumlah_kategori", _I), ("portal", _LIST), ("ada_disambiguasi", _B),
    ("meta_html", _schema(("title", _S), ("lang", _S), ("canonical", _S),
                          ("og_description", _S))))

# Item type name -> (schema, fields that must not be missing)
ITEM_TYPES = {
    "BookItem": (BOOK, ("judul", "harga")),
    "ArticleItem": (ARTICLE, ("judul", "url")),
    "BookStructureItem": (BOOK_STRUCTURE, ()),
    "WikiStructureItem": (WIKI_STRUCTURE, ()),
}

PAGES = _schema(("page_id", T.LongType()), ("url", _S), ("html", _S))
