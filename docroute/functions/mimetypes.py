"""Mimetype predicates: each takes the name of the mimetype column and gives a
boolean column.

Lists match the whole value, case-sensitively.  Patterns search inside the
value unless they are anchored.  A NULL mimetype matches nothing.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docroute.functions.flags import quote

# The mimetypes each rule recognises.

ARCHIVE = [
    "application/gzip",
    "application/vnd.ms-cab-compressed",
    "application/x-7z-compressed",
    "application/x-ace-compressed",
    "application/x-alz-compressed",
    "application/x-apple-diskimage",
    "application/x-arj",
    "application/x-astrotite-afa",
    "application/x-b1",
    "application/x-bzip2",
    "application/x-cfs-compressed",
    "application/x-compress",
    "application/x-cpio",
    "application/x-dar",
    "application/x-dgc-compressed",
    "application/x-gca-compressed",
    "application/x-gtar",
    "application/x-lzh",
    "application/x-lzip",
    "application/x-lzma",
    "application/x-lzop",
    "application/x-lzx",
    "application/x-par2",
    "application/x-rar-compressed",
    "application/x-sbx",
    "application/x-shar",
    "application/x-snappy-framed",
    "application/x-stuffit",
    "application/x-stuffitx",
    "application/x-tar",
    "application/x-xz",
    "application/x-zoo",
    "application/zip",
]

SPREADSHEET = [
    "application/vnd.lotus-1-2-3",
    "application/vnd.ms-excel",
    "application/vnd.ms-excel.sheet.macroenabled.12",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.template",
    "application/vnd.stardivision.calc",
    "application/vnd.sun.xml.calc",
    "application/vnd.sun.xml.calc.template",
]

ANALYSABLE = ["text/csv", "text/tab-separated-values"]

XML = [
    "application/rdf+xml",
    "application/smil+xml",
    "application/vnd.google-earth.kml+xml",
    "application/xml",
    "application/xslt+xml",
    "image/svg+xml",
    "model/x3d+xml",
    "text/xml",
    "xml/dtd",
]

TEXT = [
    "message/news",
    "message/rfc822",
    "text/aln",
    "text/calendar",
    "text/css",
    "text/fasta",
    "text/hkl",
    "text/html",
    "text/markdown",
    "text/matlab",
    "text/nex",
    "text/plain",
    "text/r",
    "text/rtf",
    "text/texmacs",
    "text/troff",
    "text/vcard",
    "text/x-asm",
    "text/x-awk",
    "text/x-bibtex",
    "text/x-c",
    "text/x-c++",
    "text/x-c++hdr",
    "text/x-c++src",
    "text/x-chdr",
    "text/x-csh",
    "text/x-csrc",
    "text/x-diff",
    "text/x-dsrc",
    "text/x-fortran",
    "text/x-gawk",
    "text/x-java",
    "text/x-lisp",
    "text/x-literate-haskell",
    "text/x-m4",
    "text/x-makefile",
    "text/x-msdos-batch",
    "text/x-objective-c",
    "text/x-pascal",
    "text/x-perl",
    "text/x-php",
    "text/x-po",
    "text/x-python",
    "text/x-ruby",
    "text/x-scala",
    "text/x-sfv",
    "text/x-sh",
    "text/x-shellscript",
    "text/x-tcl",
    "text/x-tex",
]

# Office documents; spreadsheets convert to raw text as well.
OFFICE = [
    "application/msword",
    "application/pdf",
    "application/rtf",
    "application/vnd.apple.pages",
    "application/vnd.ms-cab-compressed",
    "application/vnd.ms-powerpoint",
    "application/vnd.oasis.opendocument.chart",
    "application/vnd.oasis.opendocument.database",
    "application/vnd.oasis.opendocument.presentation",
    "application/vnd.oasis.opendocument.text",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "application/vnd.openxmlformats-officedocument.presentationml.slideshow",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "application/vnd.sun.xml.draw.template",
    "application/vnd.sun.xml.impress.template",
    "application/vnd.visio",
    "application/vnd.wordperfect",
    "application/x-appleworks3",
    "application/x-ms-manifest",
    "application/x-ms-pdb",
    "application/x-msaccess",
]

PDF = "application/pdf"

TABULAR_TEXT_PATTERN = r"^(text/(csv|tab.*))$"
HTML_PATTERN = r"(text/((x-server-parsed-|webview)*html))"
CHEMICAL_PATTERN = r"chemical/(.*)"
IMAGE_PATTERN = r"image/(.*)"
AUDIO_PATTERN = r"audio/(.*)"
VIDEO_PATTERN = r"video/(.*)"

# End of the fixed values.


def _one_of(mimetype: str, values: list[str]) -> Column:
    return F.expr(f"coalesce({mimetype} IN ({', '.join(map(quote, values))}), false)")


def _found(mimetype: str, pattern: str) -> Column:
    return F.expr(f"coalesce({mimetype} RLIKE {quote(pattern)}, false)")


def is_archive(mimetype: str = "mimetype") -> Column:
    return _one_of(mimetype, ARCHIVE)


def is_spreadsheet(mimetype: str = "mimetype") -> Column:
    return _one_of(mimetype, SPREADSHEET)


def is_analysable(mimetype: str = "mimetype") -> Column:
    return _one_of(mimetype, ANALYSABLE)


def is_tabular_text(mimetype: str = "mimetype") -> Column:
    return _found(mimetype, TABULAR_TEXT_PATTERN)


def is_html(mimetype: str = "mimetype") -> Column:
    return _found(mimetype, HTML_PATTERN)


def is_xml(mimetype: str = "mimetype") -> Column:
    return _one_of(mimetype, XML)


def is_text(mimetype: str = "mimetype") -> Column:
    return _one_of(mimetype, TEXT)


def is_raw_text_convertible(mimetype: str = "mimetype") -> Column:
    return _one_of(mimetype, OFFICE + SPREADSHEET)


def needs_page_images(mimetype: str = "mimetype") -> Column:
    return _one_of(mimetype, [PDF])


def needs_bounding_boxes(mimetype: str = "mimetype") -> Column:
    return _one_of(mimetype, [PDF])


def is_chemical(mimetype: str = "mimetype") -> Column:
    return _found(mimetype, CHEMICAL_PATTERN)


def is_image(mimetype: str = "mimetype") -> Column:
    return _found(mimetype, IMAGE_PATTERN)


def is_audio(mimetype: str = "mimetype") -> Column:
    return _found(mimetype, AUDIO_PATTERN)


def is_video(mimetype: str = "mimetype") -> Column:
    return _found(mimetype, VIDEO_PATTERN)


PREDICATES = {
    "is_archive": is_archive,
    "is_spreadsheet": is_spreadsheet,
    "is_analysable": is_analysable,
    "is_tabular_text": is_tabular_text,
    "is_html": is_html,
    "is_xml": is_xml,
    "is_text": is_text,
    "is_raw_text_convertible": is_raw_text_convertible,
    "needs_page_images": needs_page_images,
    "needs_bounding_boxes": needs_bounding_boxes,
    "is_chemical": is_chemical,
    "is_image": is_image,
    "is_audio": is_audio,
    "is_video": is_video,
}
