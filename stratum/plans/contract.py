"""Columns of the gold tables that are copied from one silver table (K6-K22), in the order in which they are hashed.

The wide multilingual tables follow a rule: a text has a column per language, first for the languages the source began
with, later ones in the groups in which they were added."""
from __future__ import annotations

# Language suffixes in the order of the source's columns, by the time they were added.
FIRST = "ptBR noNO enUS esES itIT arSA svSV plPL csCS frFR thTH zhZH".split()
SECOND = "deDE bgBG roRO elEL trTR".split()
THIRD = "esEP".split()
FOURTH = "huHU nlNL skSK ukUA".split()
# Who changed a row and when.
TRACKED = "DataHoraCriacao UsuarioCriacaoId DataHoraAlteracao UsuarioAlteracaoId DataHoraExclusao SYNC_DATE".split()


def texts(names: str, languages: list[str]) -> list[str]:
    """Every language of the first text, then of the next one."""
    return [f"{n}_{lang}" for n in names.split() for lang in languages]


def by_language(names: str, languages: list[str]) -> list[str]:
    """Every text in the first language, then in the next one."""
    return [f"{n}_{lang}" for lang in languages for n in names.split()]


def colours(names: str) -> list[str]:
    return [f"{n}{part}" for n in names.split() for part in ("Id", "CorFundo", "CorTexto", "Peso")]


# The columns of each gold table.
COLUMNS = {
    "dim_language_risk_class": "Id IdiomaId Descricao Criterio ClasseRiscoIdiomaId".split(),
    "fact_action": ("Id AcaoStatus AcaoPaiId DtInicio DtFim OqueSeraFeito ComoSeraFeito PorqueSeraFeito Andamento ValorPrevisto "
                    "PlanoAcaoId Sequencia AcaoTipoId Encerrado UsuarioPlanejadorId MoedaSelecionadaSigla").split(),
    "fact_risk_action": ("Id AcaoId RiscoId AmbientalId BowtieId DesvioId AcidenteInvestigacaoId RiscoAntes RiscoDepois RiscoDiff RiscoDetalhes "
                         "Deletado RiscoOcupacionalJSON AprovacaoProcessamento AprovacaoProcessamentoIniciado").split(),
    "dim_characterization": [
        "Id", *texts("Descricao", FIRST),
        *("Descricao Tipo Obrigatorio CampoFormularioCustomizado CampoRiscoAmbiental CampoRiscoOcupacional Ocupacional Ambiental "
          "FormularioCustomizado PGRDefinicao ModoComplexoTemplate ModoLista").split(), *TRACKED,
        *texts("PGRDefinicao", sorted(FIRST)), "MultiSelecao", *by_language("Descricao PGRDefinicao", SECOND + THIRD), *texts("Descricao PGRDefinicao", FOURTH)],
    "dim_option_characterization": ["Id", "Caracterizacao", *TRACKED, "CaracterizacaoOpcaoIdioma_Descricao"],
    "dim_language_option_characterization": "Id IdiomaId Descricao CaracterizacaoOpcaoIdiomaId".split(),
    "dim_control": ["Id", "Codigo", "CategoriaId", "Atuacao", *TRACKED, "ControleIdioma_Descricao"],
    "dim_language_category_control": "Id IdiomaId Descricao Criterio".split(),
    "fact_lottery": [
        "Id", "UnidadeId", *texts("UnidadeHierarquia", FIRST), "UnidadeHierarquia", *texts("UnidadeDescricao Observacoes", FIRST),
        *"UrlImagem Status UsuarioEmissaoUsername UsuarioEmissaoNome DataEmissao DataVencimento".split(), *texts("CamposPersonalizados", FIRST),
        *"CamposPersonalizados UnidadeDescricao Observacoes Deletado LOTOId Sequencia".split(),
        *by_language("CamposPersonalizados Observacoes UnidadeDescricao UnidadeHierarquia", SECOND), "MapaNumero",
        *by_language("UnidadeHierarquia UnidadeDescricao Observacoes CamposPersonalizados", THIRD),
        *texts("CamposPersonalizados Observacoes UnidadeDescricao UnidadeHierarquia", FOURTH)],
    "fact_block_lottery": [
        "Id", "LotoId", "EnergiaId", "Identificacao", *texts("LocaisBloqueio", FIRST), "LocaisBloqueio", *texts("MetodosBloqueio", FIRST),
        *"MetodosBloqueio EvidenciaId Sequencia Deletado SequenciaMigracao BloqueioId".split(), *by_language("LocaisBloqueio MetodosBloqueio", SECOND),
        "LOTOBloqueioIdOriginal", *by_language("LocaisBloqueio MetodosBloqueio", THIRD), *texts("LocaisBloqueio MetodosBloqueio", FOURTH)],
    "fact_occupational_safety_map": "Id UnidadeId Status UsuarioEmissaoUsername UsuarioEmissaoNome DataEmissao DataVencimento Deletado MapaNumero".split(),
    "fact_occupational_risk_safety_map": [
        *"Id MapaSegurancaId RiscoOcupacionalId Unidade Perigo".split(),
        *colours("Probabilidade ProbabilidadePosControle Severidade Classe ClassePosControle"), "Evidencias", "Deletado"],
    "fact_control_measure": ("Id QualidadeId ControleId RiscoOcupacionalId RiscoAmbientalId Nota Deletado DataHoraCriacao UsuarioCriacaoId "
                             "DataHoraAlteracao UsuarioAlteracaoId DataHoraExclusao MobileId SYNC_DATE IdAtual ColunaAtual").split(),
    "dim_danger": ["Id", "ClasseId", "AgenteId", *TRACKED, "PerigoIdioma_Descricao", "PictogramaId", "PerigoIdioma_Detalhes", "EnergiaId"],
    "dim_danger_class": ["Id", *texts("Descricao", FIRST), "Descricao", "Modulo", *texts("Descricao", SECOND), "Tipo", *texts("Descricao", THIRD + FOURTH), "Descricao_ltLT"],
    "dim_language_danger": "Id IdiomaId Descricao Detalhes PerigoIdiomaId".split(),
}

FLAGS = set(("Deletado Encerrado Obrigatorio CampoFormularioCustomizado CampoRiscoAmbiental CampoRiscoOcupacional Ocupacional Ambiental "
             "FormularioCustomizado ModoComplexoTemplate ModoLista MultiSelecao AprovacaoProcessamento AprovacaoProcessamentoIniciado").split())
WHOLE = set("AcaoStatus Status Sequencia SequenciaMigracao Tipo Modulo MapaNumero".split())


def column_type(name: str) -> str:
    """The type of a column, which its name tells: identifiers, times, flags, whole numbers, amounts, and texts."""
    if name == "MobileId":
        return "string"   # a device's own identifier
    if name in FLAGS:
        return "boolean"
    if name in WHOLE:
        return "int"
    if name.startswith(("Dt", "Data")) or name == "SYNC_DATE":
        return "timestamp_ntz"
    if name.endswith("Id") or name in ("IdAtual", "LOTOBloqueioIdOriginal"):
        return "bigint"
    if name.endswith("Peso") or name in ("ValorPrevisto", "Nota"):
        return "double"
    return "string"
