"""Translation models from public libraries, if these are installed. Each is built on an executor when its first piece comes."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import partial
from typing import Any, Protocol

from weftline.operators.translation import Model, first_available

# Checkpoints in the order in which they are tried, languages, and the longest output in tokens.
DEFAULTS = ["ai4bharat/indictrans2-indic-en-dist-200M", "facebook/nllb-200-distilled-600M"]
SOURCE, TARGET, MOST_NEW_TOKENS = "tam_Taml", "eng_Latn", 256


class Wrapping(Protocol):
    """What a model needs done to texts before its tokenizer and after it."""

    def preprocess_batch(self, texts: list[str], src_lang: str, tgt_lang: str) -> list[str]: ...

    def postprocess_batch(self, texts: list[str], lang: str) -> list[str]: ...


def pick_device() -> str:
    """cuda if there is one, else cpu."""
    try:
        import torch
    except ImportError:
        return "cpu"
    return "cuda" if torch.cuda.is_available() else "cpu"


class Seq2Seq:
    """A sequence-to-sequence model. With `wrapping`, texts carry their languages themselves; without, the first token that is generated names the target."""

    def __init__(self, name: str, tokenizer: Any, model: Any, device: str, beams: int, wrapping: Wrapping | None = None) -> None:
        self.name, self.tokenizer, self.model, self.device, self.beams, self.wrapping = name, tokenizer, model, device, beams, wrapping
        self.extra: dict[str, Any] = {"use_cache": True, "min_length": 0} if wrapping else {"forced_bos_token_id": tokenizer.convert_tokens_to_ids(TARGET)}

    def before(self, texts: list[str]) -> list[str]:
        return self.wrapping.preprocess_batch(texts, src_lang=SOURCE, tgt_lang=TARGET) if self.wrapping else texts

    def count_tokens(self, text: str) -> int:
        return len(self.tokenizer(self.before([text])[0])["input_ids"])

    def generate(self, batch: Any) -> Any:
        return self.model.generate(**batch, max_length=MOST_NEW_TOKENS, num_beams=self.beams, **self.extra)

    def translate(self, texts: list[str]) -> list[str]:
        batch = self.tokenizer(self.before(texts), padding=True, truncation=True, return_tensors="pt").to(self.device)
        try:
            out = self.generate(batch)
        except AttributeError as e:  # a model whose code and library differ in the form of the cache works without it
            if not self.extra.get("use_cache"):
                raise
            logging.warning("%s: no generation cache (%s), slower", self.name, e)
            self.extra["use_cache"] = False
            out = self.generate(batch)
        said = self.tokenizer.batch_decode(out, skip_special_tokens=True)
        return self.wrapping.postprocess_batch(said, lang=TARGET) if self.wrapping else said


def load(checkpoint: str, device: str | None = None, beams: int = 2) -> Seq2Seq:
    """A checkpoint of the transformers library; those that need a processor of their own bring their code with them."""
    import torch
    from transformers import AutoModelForSeq2SeqLM, AutoTokenizer

    device = device or pick_device()
    wrapping = None
    if "indictrans2" in checkpoint.lower():
        from IndicTransToolkit.processor import IndicProcessor

        wrapping = IndicProcessor(inference=True)
    tokens = {"trust_remote_code": True} if wrapping else {"src_lang": SOURCE}
    weights = {"trust_remote_code": True} if wrapping else {}
    tokenizer = AutoTokenizer.from_pretrained(checkpoint, **tokens)
    model = AutoModelForSeq2SeqLM.from_pretrained(checkpoint, torch_dtype=torch.float16 if device == "cuda" else torch.float32, **weights).to(device).eval()
    torch.set_grad_enabled(False)
    return Seq2Seq(checkpoint, tokenizer, model, device, beams, wrapping)


def choose(checkpoints: list[str], device: str | None = None, beams: int = 2) -> Callable[[], Model]:
    """A factory of the first of the models that loads."""
    return first_available(*(partial(load, c, device=device, beams=beams) for c in checkpoints))
