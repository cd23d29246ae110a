"""Synthetic post lines in the shapes the engine has to deal with."""

import json


def post(
    id=1,
    text="hello #Spark",
    user=(10, "Ann"),
    lang="en",
    tags=(),
    created_at="Thu Mar 14 13:26:53 +0000 2019",
    **members,
):
    doc = {
        "created_at": created_at,
        "id": id,
        "id_str": str(id),
        "text": text,
        "user": {"id": user[0], "name": user[1]},
        "lang": lang,
        "entities": {"hashtags": [{"text": tag, "indices": [0, 1]} for tag in tags]},
        **members,
    }
    return json.dumps(doc, ensure_ascii=False)


def write_files(folder, **files):
    """``name=[line, ...]`` pairs as ``name.json`` files; returns the folder."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in files.items():
        (folder / f"{name}.json").write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    return str(folder)
